"""Queries that profile a chunk."""

from __future__ import annotations

from pyspark.sql import functions as F

from chunkgate.catalog.bindings import E_RAW, e_raw, r4, r_raw, table
from chunkgate.functions.keys import canonical_key
from chunkgate.operators import profile
from chunkgate.sources.tables import stored

SPREAD_COLUMNS = ["target", "l_quantity", "l_discount", "l_tax"]


def q_distinct_keys(spark, sf):
    raw = e_raw(spark, sf)
    return profile.distinct_keys(raw.withColumn("k", canonical_key(raw, "k")), "k")


def _chunk_sketches(spark, sf):
    """Lines by return flag as chunks: a stored sketch of each chunk's keys."""
    lines = r_raw(spark, sf).select("k", "l_returnflag")
    return lines, stored(profile.key_sketches(lines, "k", ["l_returnflag"]), "key-sketches")


def q_distinct_keys_sketch(spark, sf):
    """Distinct keys of each chunk and of all chunks, exact, and whether the stored sketches come within 2 %."""
    lines, sketches = _chunk_sketches(spark, sf)
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct("k").alias("n_keys"))
    exact = exact.unionByName(lines.agg(F.lit("all").alias("l_returnflag"), F.count_distinct("k").alias("n_keys")))
    found = profile.sketched_keys(sketches, ["l_returnflag"]).unionByName(profile.sketched_keys(sketches).withColumn("l_returnflag", F.lit("all")))
    near = F.abs(F.col("estimate") - F.col("n_keys")) <= 0.02 * F.col("n_keys")
    return exact.join(found.withColumnRenamed("n_keys", "estimate"), "l_returnflag").select("l_returnflag", "n_keys", near.alias("within_two_percent"))


def q_shared_keys_sketch(spark, sf):
    """Keys that returned and other lines share, exact, and whether two sketches tell it within 2 % of all keys."""
    lines, sketches = _chunk_sketches(spark, sf)
    returned = F.col("l_returnflag") == "R"
    sides = lines.groupBy("k").agg(F.max(returned.cast("int")).alias("a"), F.max((~returned).cast("int")).alias("b"))
    exact = sides.agg(F.count(F.lit(1)).alias("all_keys"), F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("shared_keys"))
    found = profile.sketched_overlap(sketches.where(returned), sketches.where(~returned)).select(F.col("shared_keys").alias("estimate"))
    near = F.abs(F.col("estimate") - F.col("shared_keys")) <= 0.02 * F.col("all_keys")
    return exact.crossJoin(found).select("all_keys", "shared_keys", near.alias("within_two_percent"))  # a row each


def q_dup_spread(spark, sf):
    found = profile.dup_spread(r_raw(spark, sf), "k", SPREAD_COLUMNS)
    return found.select("k", "copies", *[r4(c).alias(c) for c in SPREAD_COLUMNS])


def q_max_dup_spread(spark, sf):
    found = profile.max_dup_spread(r_raw(spark, sf), "k", SPREAD_COLUMNS)
    return found.select("column_name", r4("max_spread").alias("max_spread"))


def q_null_profile(spark, sf):
    return profile.null_profile(e_raw(spark, sf))


def q_describe_target(spark, sf):
    found = profile.describe_target(table(spark, sf, "lineitem"), "l_extendedprice")
    return found.select("n_rows", *[r4(c).alias(c) for c in found.columns if c != "n_rows"])


def q_describe_chunk(spark, sf):
    found = profile.describe_target(e_raw(spark, sf), "target")
    return found.select("n_rows", *[r4(c).alias(c) for c in found.columns if c != "n_rows"])


def q_histogram(spark, sf):
    return profile.histogram(table(spark, sf, "orders"), "o_totalprice")


def q_mean_abs_ranked(spark, sf):
    customers = table(spark, sf, "customer")
    found = profile.mean_abs_ranked(customers, profile.numeric_columns(customers))
    return found.select("column_name", r4("mean_abs").alias("mean_abs"))


_SPREADS = ", ".join(f"max({c}) - min({c}) AS {c}" for c in SPREAD_COLUMNS)
_DUPS = f"""WITH r AS (SELECT l_orderkey || ':' || l_linenumber AS k, l_extendedprice AS target, * FROM lineitem),
d AS (SELECT k, count(*) AS copies, {_SPREADS} FROM r GROUP BY k HAVING count(*) > 1)"""


def _describe_sql(source: str, column: str) -> str:
    return f"""SELECT count({column}) AS n_rows, round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS std,
        round(min({column}), 4) AS min, round(quantile_cont({column}, 0.25), 4) AS q25,
        round(quantile_cont({column}, 0.5), 4) AS q50, round(quantile_cont({column}, 0.75), 4) AS q75,
        round(max({column}), 4) AS max FROM {source}"""


QUERIES = {
    "distinct_keys_sketch": (q_distinct_keys_sketch, """WITH t AS (SELECT l_orderkey || ':' || l_linenumber AS k, l_returnflag FROM lineitem)
        SELECT l_returnflag, count(DISTINCT k) AS n_keys, TRUE AS within_two_percent FROM t GROUP BY 1
        UNION ALL SELECT 'all', count(DISTINCT k), TRUE FROM t"""),
    "shared_keys_sketch": (q_shared_keys_sketch, """WITH t AS (SELECT l_orderkey || ':' || l_linenumber AS k,
          bool_or(l_returnflag = 'R') AS a, bool_or(l_returnflag <> 'R') AS b FROM lineitem GROUP BY 1)
        SELECT count(*) AS all_keys, count(*) FILTER (a AND b) AS shared_keys, TRUE AS within_two_percent FROM t"""),
    "distinct_keys": (q_distinct_keys, f"""WITH {E_RAW},
        t AS (SELECT nullif(lower(trim(regexp_replace(raw, '\\s+', ' ', 'g'))), '') AS k FROM e_raw)
        SELECT count(k) AS n_keys, count(DISTINCT k) AS distinct_keys FROM t"""),
    "dup_spread": (q_dup_spread, f"""{_DUPS} SELECT k, copies,
        {', '.join(f'round({c}, 4) AS {c}' for c in SPREAD_COLUMNS)} FROM d"""),
    "max_dup_spread": (q_max_dup_spread, f"{_DUPS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(max({c}), 4) AS max_spread FROM d" for c in SPREAD_COLUMNS)),
    "null_profile": (q_null_profile, f"WITH {E_RAW} " + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({source} IS NULL) AS null_rows, '{kind}' AS column_type FROM e_raw"
        for name, source, kind in [
            ("ord", "ord", "bigint"), ("k", "raw", "string"), ("target", "target", "double"),
            ("source", "source", "string"), ("chunk", "chunk", "bigint")])),
    "describe_target": (q_describe_target, _describe_sql("lineitem", "l_extendedprice")),
    "describe_chunk": (q_describe_chunk, f"WITH {E_RAW} {_describe_sql('e_raw', 'target')}"),
    "histogram": (q_histogram, """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
        t AS (SELECT least(CAST(floor((o_totalprice - lo) / ((hi - lo) / 80)) AS BIGINT), 79) AS bin FROM orders, b),
        c AS (SELECT bin, count(*) AS n FROM t GROUP BY bin)
        SELECT r.bin, coalesce(n, 0) AS n_rows FROM (SELECT unnest(range(80)) AS bin) r LEFT JOIN c USING (bin)"""),
    "mean_abs_ranked": (q_mean_abs_ranked, " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(abs({c})), 4) AS mean_abs FROM customer"
        for c in ["c_custkey", "c_nationkey", "c_acctbal"])),
}
