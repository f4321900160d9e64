"""The given tables in the roles of chunks, ledgers and registries, in Spark and in SQL.

Every binding reads the whole table. Rows with a missing key or target are sown in by
expression, since the tables have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkgate.functions.keys import collapsed_text
from chunkgate.operators.bootstrap import MAX_WEIGHT, PRIME, poisson_limits
from chunkgate.operators.models import fit_lines, line_columns
from chunkgate.operators.ranking import cut_points, with_range_bucket, with_row_number
from chunkgate.operators.split import held_out_rows, train_rows, with_split
from chunkgate.operators.validate import validated
from chunkgate.sources.tables import read_table, stored

MIN_KEY_CHARS = 60
R_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
ROLLBACK_TIME = "2024-02-01 00:00:00"


def table_file(path):
    """A file's name, or for a table that is a folder the table's and the file's."""
    return F.regexp_extract(path, r"([^/]+\.parquet(/.*)?)$", 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def r4(column: Column | str) -> Column:
    return F.round(column, 4)


# E: documents as an entity chunk -------------------------------------------------


def e_rule(value: Column) -> Column:
    """Texts of fewer than 60 characters do not parse."""
    return F.when(F.length(value) >= MIN_KEY_CHARS, collapsed_text(value))


def e_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = table(spark, sf_dir, "documents")
    return doc.select(
        F.col("doc_id").alias("ord"),
        F.when(F.col("doc_id") % 23 != 0, F.col("text")).alias("k"),
        F.when(F.col("doc_id") % 29 != 0, F.col("n_chars").cast("double")).alias("target"),
        "source",
        (F.col("doc_id") % 4).alias("chunk"),
    )


def e_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(e_raw(spark, sf_dir), "k", "target", ["ord"], e_rule)


def e_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored, for fitting and judging read it one after the other."""
    split = with_split(e_valid(spark, sf_dir), "k").withColumn("x", F.size(F.split("k", " ")).cast("double"))
    return stored(split.select("ord", "k", "target", "x", "is_test"), "documents-split", ["is_test"])


E_RAW = """e_raw AS (
  SELECT doc_id AS ord, source, doc_id % 4 AS chunk,
    CASE WHEN doc_id % 23 <> 0 THEN text END AS raw,
    CASE WHEN doc_id % 29 <> 0 THEN CAST(n_chars AS DOUBLE) END AS target
  FROM documents),
e_key AS (
  SELECT *, CASE WHEN length(raw) >= 60 THEN
    nullif(lower(trim(regexp_replace(raw, '\\s+', ' ', 'g'))), '') END AS k FROM e_raw)"""
E_VALID = E_RAW + """,
e_valid AS (
  SELECT * FROM e_key WHERE raw IS NOT NULL AND target IS NOT NULL AND k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY ord) = 1)"""
E_SPLIT = E_VALID + """,
e_split AS (
  SELECT *, CAST(len(string_split(k, ' ')) AS DOUBLE) AS x,
    ('0x' || substr(md5('7:' || k), 1, 8))::BIGINT / 4294967295.0 < 0.2 AS is_test FROM e_valid)"""


# R: lineitem as a regression chunk -------------------------------------------------


def r_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = table(spark, sf_dir, "lineitem")
    return item.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("k"),
        F.col("l_extendedprice").alias("target"),
        *R_ORDER, "l_quantity", "l_discount", "l_tax", "l_returnflag",
    )


def r_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(r_raw(spark, sf_dir), "k", "target", R_ORDER)


def r_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored like ``e_split``."""
    split = with_split(r_valid(spark, sf_dir), "k").drop(*R_ORDER)
    return stored(split, "lines-split", ["is_test"])


R_VALID = """r_raw AS (
  SELECT l_orderkey || ':' || l_linenumber AS k, l_extendedprice AS target, * FROM lineitem),
r_valid AS (
  SELECT * FROM r_raw QUALIFY row_number() OVER (PARTITION BY k
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1)"""
R_SPLIT = R_VALID + """,
r_split AS (
  SELECT *, ('0x' || substr(md5('7:' || k), 1, 8))::BIGINT / 4294967295.0 < 0.2 AS is_test FROM r_valid)"""


# Errors of a one-feature ridge (candidate) and the mean (champion) -----------------


def e_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored, since the gate reads the errors for its statistics and for its interval."""
    split = e_split(spark, sf_dir)
    line = line_columns(fit_lines(train_rows(split), "x", "target"))
    judged = held_out_rows(split).withColumn("_line", line)
    candidate = F.col("_line.intercept") + F.col("_line.slope") * F.col("x")
    errors = judged.select(
        "ord", "k", "target",
        candidate.alias("candidate"),
        F.col("_line.mean_target").alias("champion"),
        F.abs(candidate - F.col("target")).alias("candidate_error"),
        F.abs(F.col("_line.mean_target") - F.col("target")).alias("champion_error"),
    )
    return stored(errors, "documents-errors")


E_ERRORS = E_SPLIT + """,
e_fit AS (
  SELECT covar_pop(target, x) * count(*) / (var_pop(x) * count(*) + 1.0) AS slope,
    avg(x) AS mean_x, avg(target) AS mean_target, count(*) AS train_rows
  FROM e_split WHERE NOT is_test),
e_pred AS (
  SELECT ord, k, target, mean_target - slope * mean_x + slope * x AS candidate, mean_target AS champion
  FROM e_split, e_fit WHERE is_test),
e_errors AS (
  SELECT *, abs(candidate - target) AS candidate_error, abs(champion - target) AS champion_error FROM e_pred)"""


def r_lines(split: DataFrame) -> DataFrame:
    """The fitted lines of every return flag, stored as a model is."""
    return stored(fit_lines(train_rows(split), "l_quantity", "target", by=["l_returnflag"]), "lines-models")


def r_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models fitted for each return flag, judged on the same held-out rows."""
    split = r_split(spark, sf_dir)
    lines = r_lines(split)
    judged = held_out_rows(split).join(lines, "l_returnflag")
    candidate = F.col("intercept") + F.col("slope") * F.col("l_quantity")
    errors = judged.select(
        "l_returnflag", "k",
        F.abs(candidate - F.col("target")).alias("candidate_error"),
        F.abs(F.col("mean_target") - F.col("target")).alias("champion_error"),
    )
    return stored(errors, "lines-errors")


R_ERRORS = R_SPLIT + """,
r_fit AS (
  SELECT l_returnflag, covar_pop(target, l_quantity) * count(*) / (var_pop(l_quantity) * count(*) + 1.0) AS slope,
    avg(l_quantity) AS mean_x, avg(target) AS mean_target, count(*) AS train_rows
  FROM r_split WHERE NOT is_test GROUP BY l_returnflag),
r_errors AS (
  SELECT s.l_returnflag, s.k, abs(mean_target - slope * mean_x + slope * l_quantity - target) AS candidate_error,
    abs(mean_target - target) AS champion_error
  FROM r_split s JOIN r_fit f USING (l_returnflag) WHERE is_test)"""


def boot_sql(errors: str, group: str = "0", n_boot: int = 1000, seed: int = 7) -> str:
    """CTEs ``boot`` (g, b, delta) and ``ci`` (g, ci_low, ci_high) over an errors CTE."""

    def word(text: str, part: int) -> str:
        return f"('0x' || substr(md5({text}), {1 + 8 * part}, 8))::BIGINT % {PRIME}"

    cases = " ".join(f"WHEN m < {limit} THEN {w}" for w, limit in enumerate(poisson_limits()))
    replicate = f"'{seed}:' || b"
    return f""",
terms AS (
  SELECT b, {word(replicate, 0)} AS fa, {word(replicate, 1)} AS fb, {word(replicate, 2)} AS fc
  FROM range({n_boot}) t(b)),
hashed AS (
  SELECT {group} AS g, champion_error - candidate_error AS d, {word('k', 0)} AS h1, {word('k', 1)} AS h2
  FROM {errors}),
drawn AS (SELECT g, b, d, (fa * h1 + fb * h2 + fc) % {PRIME} AS m FROM hashed, terms),
boot AS (
  SELECT g, b, sum(w * d) / nullif(sum(w), 0) AS delta
  FROM (SELECT g, b, d, CAST(CASE {cases} ELSE {MAX_WEIGHT} END AS DOUBLE) AS w FROM drawn) GROUP BY g, b),
ci AS (
  SELECT g, quantile_cont(delta, 0.025) AS ci_low, quantile_cont(delta, 0.975) AS ci_high FROM boot GROUP BY g)"""


def multinomial_sql(errors: str, n_boot: int = 1000, seed: int = 7) -> str:
    """CTE ``boot`` (b, n_draws, delta): draws that go down the tree of key hashes by binomials. For WITH RECURSIVE."""

    def word(text: str, part: int) -> str:
        return f"('0x' || substr(md5({text}), {1 + 8 * part}, 8))::BIGINT % {PRIME}"

    replicate, node = f"'{seed}:' || b", "p.level || ':' || p.prefix"
    mass = "exp(lgamma(m + 1) - lgamma(i + 1) - lgamma(m - i + 1) + i * ln(share) + (m - i) * ln(1 - share))"
    upto = f"list_sum(list_transform(range(0, j + 1), lambda i: {mass}))"
    return f""",
leaves AS (
  SELECT ('0x' || substr(md5(k), 1, 15))::BIGINT AS h, champion_error - candidate_error AS d FROM {errors}),
nodes AS (
  SELECT level, h >> (60 - level) AS prefix, count(*) AS n, avg(d) AS d FROM leaves, range(0, 61) t(level) GROUP BY 1, 2),
terms AS (
  SELECT b, {word(replicate, 0)} AS fa, {word(replicate, 1)} AS fb, {word(replicate, 2)} AS fc FROM range({n_boot}) t(b)),
forks AS (
  SELECT p.level, p.prefix, l.n AS nl, r.n AS nr, l.n / (l.n + r.n) AS share, {word(node, 0)} AS h1, {word(node, 1)} AS h2
  FROM nodes p LEFT JOIN nodes l ON l.level = p.level + 1 AND l.prefix = p.prefix * 2
    LEFT JOIN nodes r ON r.level = p.level + 1 AND r.prefix = p.prefix * 2 + 1
  WHERE p.n > 1),
draws AS (
  SELECT CAST(0 AS BIGINT) AS level, CAST(0 AS BIGINT) AS prefix, b, n AS m FROM terms, nodes WHERE level = 0
  UNION ALL
  SELECT level + 1, prefix * 2 + side, b, CAST(CASE WHEN nl IS NULL OR nr IS NULL THEN m WHEN side = 0 THEN k ELSE m - k END AS BIGINT)
  FROM (
    SELECT *, least(m, len(list_filter(list_transform(range(0, m + 1), lambda j: {upto}), lambda x: x <= u))) AS k
    FROM (SELECT level, prefix, b, m, nl, nr, share, ((fa * h1 + fb * h2 + fc) % {PRIME} + 0.5) / {PRIME} AS u
      FROM draws JOIN forks USING (level, prefix) JOIN terms USING (b))) f, (SELECT unnest([0, 1]) AS side)
  WHERE (side = 0 AND nl IS NOT NULL) OR (side = 1 AND nr IS NOT NULL)),
boot AS (
  SELECT b, CAST(sum(m) AS BIGINT) AS n_draws, sum(m * d) / sum(m) AS delta
  FROM draws JOIN nodes USING (level, prefix) WHERE n = 1 GROUP BY b)"""


# Event ids as arriving text files ---------------------------------------------------------


def landed_texts(spark: SparkSession, landing: str, sf_dir: str) -> str:
    """A file of sorted event ids for each event type, those of the first type twice: byte for byte a copy."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id")
    kinds = sorted(r[0] for r in events.select("event_type").distinct().collect())
    for folder, kind in [(kind, kind) for kind in kinds] + [("z-copy", kinds[0])]:
        ids = events.where(F.col("event_type") == kind).orderBy("event_id").coalesce(1)
        ids.select(F.col("event_id").cast("string")).write.text(f"{landing}/{folder}")
    return landing


LANDED_TEXTS = """SELECT event_type AS folder, CAST(sum(length(CAST(event_id AS VARCHAR)) + 1) AS BIGINT) AS length,
  sha256(string_agg(CAST(event_id AS VARCHAR) || chr(10), '' ORDER BY event_id)) AS digest FROM events GROUP BY event_type"""


# L: events as a run ledger -----------------------------------------------------------


def l_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = table(spark, sf_dir, "events")
    return event.select(
        F.col("event_id").alias("run_id"),
        F.concat(F.lit("m"), F.col("user_id") % 20).alias("model_name"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("status"),
        F.col("ts").alias("start_time"),
        F.md5(F.concat_ws(":", "user_id", "props")).alias("raw_data_hash"),
        F.col("value").alias("candidate_mae"),
        F.col("event_type").alias("model_kind"),
        (F.col("event_type") == "purchase").alias("promote"),
        F.concat(F.lit("chunk-"), F.col("user_id"), F.lit(".csv")).alias("raw_path"),
        "props",
    )


L_RUNS = """runs AS (
  SELECT event_id AS run_id, 'm' || (user_id % 20) AS model_name,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS status, ts AS start_time,
    md5(user_id || ':' || props) AS raw_data_hash, value AS candidate_mae, event_type AS model_kind,
    event_type = 'purchase' AS promote, 'chunk-' || user_id || '.csv' AS raw_path, props
  FROM events)"""


# V: events as model versions -----------------------------------------------------------


def v_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = table(spark, sf_dir, "events").filter(F.col("event_type").isin("purchase", "signup"))
    numbered = event.select(
        F.concat(F.lit("m"), F.col("user_id") % 20).alias("model_name"),
        "event_id", "event_type", "ts",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
    )
    bucketed = with_range_bucket(numbered, "micros", cut_points(numbered, "micros"))
    versions = with_row_number(bucketed, ["ts", "event_id"], by=["model_name"], name="version")
    again = (F.col("event_id") % 10 == 0) & (F.col("event_type") == "purchase")
    return versions.select(
        "model_name",
        F.col("version").cast("bigint").alias("version"),
        F.col("event_id").alias("run_id"),
        F.when(again, F.expr("ts + INTERVAL 2 HOURS"))
        .when(F.col("event_type") == "purchase", F.col("ts"))
        .alias("promoted_at"),
        F.when((F.col("event_id") % 5 == 0) | (F.col("event_id") % 7 == 0), F.expr("ts + INTERVAL 1 HOUR")).alias(
            "rolled_back_at"
        ),
    )


def v_champions(state: DataFrame) -> DataFrame:
    """Each model's newest promoted version."""
    return (
        state.filter(F.col("promoted_at").isNotNull())
        .groupBy("model_name")
        .agg(F.max("version").alias("version"))
    )


V_STATE = """state AS (
  SELECT 'm' || (user_id % 20) AS model_name, event_id AS run_id,
    row_number() OVER (PARTITION BY user_id % 20 ORDER BY ts, event_id) AS version,
    CASE WHEN event_type = 'purchase' THEN
      CASE WHEN event_id % 10 = 0 THEN ts + INTERVAL 2 HOUR ELSE ts END END AS promoted_at,
    CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN ts + INTERVAL 1 HOUR END AS rolled_back_at
  FROM events WHERE event_type IN ('purchase', 'signup')),
champions AS (
  SELECT model_name, max(version) AS version FROM state WHERE promoted_at IS NOT NULL GROUP BY model_name),
eligible AS (
  SELECT s.* FROM state s JOIN champions c USING (model_name)
  WHERE s.version < c.version AND promoted_at IS NOT NULL
    AND (rolled_back_at IS NULL OR rolled_back_at < promoted_at)),
targets AS (
  SELECT c.model_name, c.version AS current_version, max(e.version) AS target_version
  FROM champions c LEFT JOIN eligible e USING (model_name) GROUP BY ALL)"""
