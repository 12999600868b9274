"""Ingest operators: parse, check, normalise, enrich, classify, upsert.

Inputs are landed payload tables ``(app_id STRING, body STRING)``, where apps
land more than once with a sortable ``landed_at`` — so every step is a column expression or a join on
``app_id``. No Python UDF anywhere.

Shuffles: the enrichment and classification joins shuffle on ``app_id``
(sort-merge or shuffle-hash, chosen by Spark from sizes); the status sets are
anti-joined on ``app_id`` the same way unless Spark measures one side under
its broadcast threshold. The last-wins upsert is one aggregation on the key
with ``max_by`` (partial aggregation: one candidate per key per task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import text as X

# Text of a rate-limited secondary response.
RATE_LIMIT_TEXT = "Too many connections"

LANDED_AT = "landed_at"  # optional column of landed tables: the latest delivery counts
NOT_RELEASED_OUTCOME, DISCARDED_OUTCOME = "not_released", "discarded"
OUTCOMES = (S.ADDED, NOT_RELEASED_OUTCOME, DISCARDED_OUTCOME, S.FAILED)


# --- primary payload ----------------------------------------------------------

def parse_primary(df: DataFrame, body: str = "body", app_id: str = "app_id") -> DataFrame:
    """Add ``parsed`` (body is JSON), ``success`` and ``data`` for each app.

    The body is ``{"<app_id>": {"success": .., "data": {..}}}``; the entry of
    the row's own app id is taken. A body that is not JSON gives
    ``parsed = false``; a JSON body without the app's key gives no success.
    """
    # parse once into its own column; later projections read the column
    parsed = df.withColumn("_m", F.from_json(F.col(body), S.PRIMARY_BODY))
    entry = F.element_at(F.col("_m"), F.col(app_id).cast("string"))
    return parsed.select(*[c for c in df.columns if c != body],
                         F.col("_m").isNotNull().alias("parsed"),
                         F.coalesce(entry["success"], F.lit(False)).alias("success"),
                         entry["data"].alias("data"))


def eligible(success: Column, data: Column) -> Column:
    """FLT1: success, type 'game', priced unless free, has developers.

    Rejected: not free, ``price_overview`` present, ``final_formatted`` == ''.
    A missing ``price_overview`` passes.
    """
    not_free = ~F.coalesce(data["is_free"], F.lit(False))
    blank_price = data["price_overview"].isNotNull() & \
        F.coalesce(data["price_overview"]["final_formatted"] == "", F.lit(False))
    has_devs = F.coalesce(F.size(data["developers"]) > 0, F.lit(False))
    return (success & F.coalesce(data["type"] == "game", F.lit(False))
            & ~(not_free & blank_price) & has_devs)


def _sub(s: Column) -> Column:
    return F.struct(X.sanitize_text(s["option_text"]).alias("text"),
                    F.coalesce(s["option_description"], F.lit("")).alias("description"),
                    X.cents_to_price(s["price_in_cents_with_discount"]).alias("price"))


def _package(g: Column) -> Column:
    subs = F.coalesce(g["subs"], F.array().cast(T.ArrayType(S.SUB_RAW)))
    return F.struct(X.sanitize_text(F.coalesce(g["title"], F.lit(""))).alias("title"),
                    X.sanitize_text(F.coalesce(g["description"], F.lit(""))).alias("description"),
                    F.transform(subs, _sub).alias("subs"))


def packages(groups: Column) -> Column:
    """PRJ8: package groups -> cleaned packages, sub prices from cents."""
    empty = F.array().cast(T.ArrayType(S.PACKAGE_GROUP_RAW))
    return F.transform(F.coalesce(groups, empty), _package)


def _text(c: Column) -> Column:
    return X.sanitize_text(X.strip_ws(F.coalesce(c, F.lit(""))))


def normalise(data: Column) -> Column:
    """PRJ7: raw ``data`` struct -> the normalised record struct.

    A missing or explicitly NULL field gets the field's default.
    """
    d = data
    price = F.when(F.coalesce(d["is_free"], F.lit(False)), F.lit(0.0)) \
        .otherwise(X.price_to_float(F.coalesce(d["price_overview"]["final_formatted"], F.lit(""))))
    return F.struct(
        X.strip_ws(F.coalesce(d["name"], F.lit(""))).alias("name"),
        X.released_date(d["release_date"]).alias("release_date"),
        X.safe_int(F.coalesce(d["required_age"], F.lit("0"))).alias("required_age"),
        price.alias("price"),
        X.list_size(d["dlc"]).alias("dlc_count"),
        _text(d["detailed_description"]).alias("detailed_description"),
        _text(d["about_the_game"]).alias("about_the_game"),
        _text(d["short_description"]).alias("short_description"),
        F.coalesce(d["platforms"]["windows"], F.lit(False)).alias("windows"),
        F.coalesce(d["platforms"]["mac"], F.lit(False)).alias("mac"),
        F.coalesce(d["platforms"]["linux"], F.lit(False)).alias("linux"),
        X.whole_number(d["metacritic"]["score"]).alias("metacritic_score"),
        X.whole_number(d["achievements"]["total"]).alias("achievements"),
        X.whole_number(d["recommendations"]["total"]).alias("recommendations"),
        X.sanitize_text(F.coalesce(d["content_descriptors"]["notes"], F.lit(""))).alias("notes"),
        X.supported_languages(d["supported_languages"]).alias("supported_languages"),
        X.full_audio_languages(d["supported_languages"]).alias("full_audio_languages"),
        packages(d["package_groups"]).alias("packages"),
        X.strip_each(d["developers"]).alias("developers"),
        X.strip_each(d["publishers"]).alias("publishers"),
        X.descriptions(d["categories"]).alias("categories"),
        X.descriptions(d["genres"]).alias("genres"),
    )


# --- secondary statistics payload ------------------------------------------------

def parse_stats(df: DataFrame, body: str = "body", app_id: str = "app_id") -> DataFrame:
    """FLT2: keep valid stats bodies, one per app, as a parsed ``stats`` struct.

    Valid: non-blank, no rate-limit text, parses as a JSON object, and a
    non-empty ``developer``. Of several valid bodies for one app the one landed
    last stays (column ``landed_at``; without it the greatest, a deterministic
    pick), so the enrichment join cannot multiply rows.
    """
    text = F.col(body)
    valid_text = (F.length(F.trim(F.coalesce(text, F.lit("")))) > 0) & \
        ~F.coalesce(text.contains(RATE_LIMIT_TEXT), F.lit(False))
    order = _landing_order(df)
    parsed = (df.where(valid_text)
              .select(app_id, F.from_json(text, S.STATS_RAW).alias("stats"), *order)
              .where(F.coalesce(F.col("stats.developer") != "", F.lit(False))))
    return parsed.groupBy(app_id).agg(F.max_by("stats", F.struct(*order, "stats")).alias("stats"))


def _landing_order(df: DataFrame) -> list[str]:
    """The column that orders deliveries, where the landed table has one."""
    return [LANDED_AT] if LANDED_AT in df.columns else []


def latest_primary(primary: DataFrame, app_id: str = "app_id", body: str = "body") -> DataFrame:
    """One parsed delivery per app: ``(app_id, parsed, success, data)``.

    A JSON body is preferred over one that is not; of those the one landed last
    (``landed_at``) counts. Equal or no landing times: one with data first, then
    by a hash of the body, the same at every run. Partial aggregation: one
    candidate per app leaves each task.
    """
    order = _landing_order(primary)
    p = parse_primary(primary.select(app_id, body, F.xxhash64(body).alias("_hash"), *order), body, app_id)
    usable = F.col("success") & F.col("data").isNotNull()
    best = F.max_by(F.struct("parsed", "success", "data"),
                    F.struct("parsed", *order, usable.alias("usable"), "_hash"))
    return p.groupBy(app_id).agg(best.alias("_best")).select(app_id, "_best.*")


# Enrichment fields -> (source key, default), in record order.
STATS_DEFAULTS = (
    ("user_score", "userscore", 0),
    ("score_rank", "score_rank", ""),
    ("positive", "positive", 0),
    ("negative", "negative", 0),
    ("estimated_owners", "owners", None),
    ("average_playtime_forever", "average_forever", 0),
    ("average_playtime_2weeks", "average_2weeks", 0),
    ("median_playtime_forever", "median_forever", 0),
    ("median_playtime_2weeks", "median_2weeks", 0),
    ("peak_ccu", "ccu", 0),
    ("tags", "tags", None),
)


def stats_columns(stats: Column) -> list[Column]:
    """The eleven enrichment fields; an unmatched app (NULL stats) gets defaults."""
    cols = []
    for name, key, default in STATS_DEFAULTS:
        if name == "estimated_owners":
            cols.append(X.owners_text(stats[key]).alias(name))
        elif name == "tags":
            cols.append(X.tags_map(stats[key]).alias(name))
        else:
            value = X.whole_number(stats[key]) if default == 0 else F.coalesce(stats[key], F.lit(default))
            cols.append(value.alias(name))
    return cols


def enrich(records: DataFrame, stats: DataFrame, app_id: str = "app_id",
           record: str = "record") -> DataFrame:
    """JN1: left outer join of records with parsed stats (``parse_stats``)."""
    joined = records.join(stats, app_id, "left")
    merged = F.struct(F.col(f"{record}.*"), *stats_columns(F.col("stats")))
    return joined.select(*[c for c in records.columns if c != record], merged.alias(record))


# --- classification (one run of the ingest) ---------------------------------------

def classify(work: DataFrame, primary: DataFrame, stats: DataFrame | None = None,
             app_id: str = "app_id") -> DataFrame:
    """DF1: each work-list app -> ``outcome`` and, when added, ``record``.

    Outcomes: ``added``; ``not_released`` (empty release date); ``discarded``
    (a JSON body that is unsuccessful or ineligible); ``failed`` (no body
    landed, or a body that is not JSON — retried next run). ``stats`` (raw
    bodies) enriches added records; ``None`` skips enrichment. Of several
    deliveries for one app ``latest_primary`` and ``parse_stats`` choose.
    """
    # Cut to the work list first: only its bodies are parsed and aggregated. A
    # work list under the broadcast threshold cuts in the scan; a larger one
    # costs one shuffle on app_id, which the aggregation and the join after it use too.
    work = work.select(app_id)
    j = (work.join(latest_primary(primary.join(work, app_id, "left_semi"), app_id), app_id, "left")
         .withColumn("ok", eligible(F.col("success"), F.col("data")))
         .withColumn("rec", normalise(F.col("data"))))
    outcome = (F.when(~F.coalesce(F.col("parsed"), F.lit(False)), F.lit(S.FAILED))
               .when(~F.col("ok"), F.lit(DISCARDED_OUTCOME))
               .when(F.col("rec.release_date") == "", F.lit(NOT_RELEASED_OUTCOME))
               .otherwise(F.lit(S.ADDED)))
    out = (j.withColumn("outcome", outcome)
           .select(app_id, "outcome",
                   F.when(F.col("outcome") == S.ADDED, F.col("rec")).alias("record")))
    if stats is None:
        return out
    # stats are cut to the work list too (not to the added apps: that would
    # recompute the classification); non-added apps ignore their stats below
    parsed_stats = parse_stats(stats.join(work, app_id, "left_semi"), app_id=app_id)
    joined = out.join(parsed_stats, app_id, "left")
    enriched = F.struct(F.col("record.*"), *stats_columns(F.col("stats")))
    return joined.select(app_id, "outcome",
                         F.when(F.col("outcome") == S.ADDED, enriched).alias("record"))


# --- status sets and work list -------------------------------------------------------

def work_list(apps: DataFrame, status: DataFrame, released: bool = True,
              app_id: str = "app_id") -> DataFrame:
    """JN2 + FLT7: apps minus processed, discarded and (if ``released``) not-released."""
    skip = [S.PROCESSED, S.DISCARDED] + ([S.NOT_RELEASED] if released else [])
    known = status.where(F.col("status").isin(skip)).select(app_id)
    return (apps.select(F.col(app_id).cast("string").alias(app_id)).distinct()
            .join(known, app_id, "left_anti"))


def last_wins(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """JN3: per key keep the whole row with the highest ``order`` (numeric).

    ``order`` must be unique per key (a batch or run number, or a struct such
    as ``(chunk_no, position)``); equal orders would leave the pick open.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    plain = [c for c in others if c != order]
    if len(plain) == 1 and not isinstance(df.schema[order].dataType, T.StructType):
        # one value: no struct, so that fixed-width ones aggregate by hash
        return (df.groupBy(*keys).agg(F.max_by(plain[0], order).alias(plain[0]), F.max(order).alias(order))
                .select(*keys, *others))
    best = F.max_by(F.struct(*others), F.col(order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def status_changes(outcomes: DataFrame, app_id: str = "app_id", keep=()) -> DataFrame:
    """SET1-SET3 as changes ``(app_id, status, present, *keep)`` of one run.

    added -> +processed and −notreleased; not_released -> +notreleased;
    discarded -> +discarded; failed -> nothing.
    """
    o = F.col("outcome")
    adds = outcomes.where(o != S.FAILED).select(
        app_id,
        F.when(o == S.ADDED, F.lit(S.PROCESSED))
         .when(o == NOT_RELEASED_OUTCOME, F.lit(S.NOT_RELEASED))
         .otherwise(F.lit(S.DISCARDED)).alias("status"),
        F.lit(True).alias("present"), *keep)
    removes = outcomes.where(o == S.ADDED).select(
        app_id, F.lit(S.NOT_RELEASED).alias("status"), F.lit(False).alias("present"), *keep)
    return adds.unionByName(removes)


def current_status(log: DataFrame, app_id: str = "app_id", run: str = "run") -> DataFrame:
    """Status sets from the change log: last change per (app, status) wins."""
    last = last_wins(log.select(app_id, "status", "present", run), [app_id, "status"], run)
    return last.where(F.col("present")).select(app_id, "status")


def update_status(status: DataFrame, outcomes: DataFrame, app_id: str = "app_id") -> DataFrame:
    """SET1-SET3 on the sets themselves: the status table after one run."""
    ch = status_changes(outcomes, app_id)
    removed = ch.where(~F.col("present")).select(app_id, "status")
    added = ch.where(F.col("present")).select(app_id, "status")
    return (status.select(app_id, "status").unionByName(added)
            .join(removed, [app_id, "status"], "left_anti").distinct())


def run_summary(apps: DataFrame, status: DataFrame, outcomes: DataFrame,
                app_id: str = "app_id") -> DataFrame:
    """AGG7 + SCL26: counts per outcome, the expected total and percent added.

    ``not_released`` counts only apps that were not already in the
    not-released set (a known one found unreleased again is no news).
    total = apps − discarded − notreleased − processed, with the set sizes
    taken before the run (an app in two sets counts in both).
    """
    n_known = status.groupBy("status").agg(F.count_distinct(app_id).alias("n")) \
        .agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    known_nr = status.where(F.col("status") == S.NOT_RELEASED).select(app_id).distinct() \
        .withColumn("_known_nr", F.lit(True))
    return summary_of(apps, n_known, outcomes.join(known_nr, app_id, "left"), app_id)


def summary_of(apps: DataFrame, n_known: Column, marked: DataFrame, app_id: str = "app_id") -> DataFrame:
    """``run_summary`` from the size of the sets before the run and its outcomes, of which
    ``_known_nr`` (else NULL) marks apps that were in the not-released set."""
    n_apps = apps.agg(F.count_distinct(app_id)).scalar()
    o = F.col("outcome")
    new_nr = (o == NOT_RELEASED_OUTCOME) & F.col("_known_nr").isNull()
    counts = marked.agg(
        F.count_if(o == S.ADDED).alias(S.ADDED),
        F.count_if(new_nr).alias(NOT_RELEASED_OUTCOME),
        F.count_if(o == DISCARDED_OUTCOME).alias(DISCARDED_OUTCOME),
        F.count_if(o == S.FAILED).alias(S.FAILED))
    total = (n_apps - n_known).cast("bigint")
    return counts.select(*OUTCOMES, total.alias("total"),
                         X.percent(F.col(S.ADDED), total).alias("percent_added"))
