"""Queries on chunks: reading, validation, splits, samples, identities, novelty."""

from __future__ import annotations

from pyspark.sql import functions as F

from chunkgate.catalog.bindings import (
    E_RAW, E_SPLIT, E_VALID, LANDED_TEXTS, R_ORDER, R_SPLIT, R_VALID, e_raw, e_rule, e_split, e_valid, landed_texts, r4,
    r_raw, r_split, r_valid, table, table_file,
)
from chunkgate.functions.fingerprint import LEFT, PRIME, RIGHT, SELF, STEP, fingerprint_bits
from chunkgate.functions.keys import canonical_key
from chunkgate.operators import identity, novelty, sampling, validate
from chunkgate.operators.split import held_out_rows, train_rows, with_split
from chunkgate.session import scratch_dir
from chunkgate.sources.arrivals import arrival_digests, distinct_arrivals
from chunkgate.sources.chunks import read_chunk
from chunkgate.sources.keyindex import KeyIndex
from chunkgate.sources.tables import stored

SAMPLE_ROWS = 5000
HALF_ROWS = 4000
SLICE_ROWS = 7500


def _key_md5(df, *columns):
    return df.select("ord", F.md5("k").alias("key_md5"), *columns)


def q_read_chunk(spark, sf):
    """Orders written as CSV, the price of open ones as a missing-value token, and read back."""
    path = scratch_dir(spark, "orders-csv")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.col("o_totalprice").cast("string"))
    table(spark, sf, "orders").select("o_orderkey", price.alias("price"), "o_orderpriority").write.csv(path, header=True)
    chunk = read_chunk(spark, path, ["price"])
    return chunk.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "price", "o_orderpriority")


def q_arrival_digest(spark, sf):
    files = arrival_digests(spark, sf, "*.parquet", recursive=True)
    return files.select(table_file("path").alias("file_name"), "length", "digest")


def q_distinct_arrivals(spark, sf):
    files = distinct_arrivals(arrival_digests(spark, sf, "*.parquet", recursive=True))
    return files.select(table_file("path").alias("file_name"), "length", "digest")


def q_distinct_texts(spark, sf):
    """Text files of which two are equal: one path for each content."""
    landing = landed_texts(spark, scratch_dir(spark, "texts"), sf)
    files = distinct_arrivals(arrival_digests(spark, landing, "*.txt", recursive=True))
    return files.select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("folder"), "length", "digest")


def q_drop_null_rows(spark, sf):
    return _key_md5(validate.drop_null_rows(e_raw(spark, sf), "k", "target"), "target")


def q_canonical_key(spark, sf):
    raw = e_raw(spark, sf)
    return raw.select("ord", canonical_key(raw, "k", e_rule).alias("k"))


def q_drop_unparseable(spark, sf):
    complete = validate.drop_null_rows(e_raw(spark, sf), "k", "target")
    return _key_md5(validate.drop_unparseable(validate.canonicalise(complete, "k", e_rule), "k"), "target")


def q_validated_frame(spark, sf):
    return e_valid(spark, sf).select("ord", "k", "target", "source")


def q_validated_lines(spark, sf):
    return r_valid(spark, sf).select("k", "target", "l_quantity", "l_returnflag")


def q_dedup_keep_first(spark, sf):
    kept = validate.keep_first(r_raw(spark, sf), "k", R_ORDER)
    return kept.select("k", "l_partkey", "l_suppkey", "target")


def q_duplicate_rows(spark, sf):
    raw = r_raw(spark, sf)
    return validate.duplicate_rows(raw.withColumn("row_id", F.struct("k", *R_ORDER)), "k", "row_id").select(
        "k", "l_partkey", "l_suppkey", "target", "copies"
    )


def q_validation_report(spark, sf):
    return validate.validation_report(e_raw(spark, sf), "k", "target", e_rule)


def q_dropped_rows(spark, sf):
    """The same counts, gathered while the valid rows are written."""
    valid, dropped = validate.validated_and_counted(e_raw(spark, sf), "k", "target", ["ord"], e_rule)
    stored(valid, "valid-rows")
    names = ["raw_rows", "null_rows", "unparseable_rows", "duplicate_rows", "valid_rows", "dropped_rows"]
    return spark.createDataFrame([tuple(dropped.counts[c] for c in names)], ", ".join(f"{c} long" for c in names))


def q_train_split(spark, sf):
    return _key_md5(train_rows(e_split(spark, sf)), "target")


def q_test_split(spark, sf):
    return _key_md5(held_out_rows(e_split(spark, sf)), "target")


def q_split_stability(spark, sf):
    """Rows that sit on another side when each chunk is split alone, by chunk: none."""
    raw = e_raw(spark, sf)
    whole = with_split(validate.validated(raw, "k", "target", ["ord"], e_rule), "k")
    parts = with_split(validate.validated(raw, "k", "target", ["ord"], e_rule, by=["chunk"]), "k")
    moved = parts.select("k", F.col("is_test").alias("there")).join(whole.select("k", "is_test"), "k")
    return moved.agg(F.count("*").alias("rows_compared"), F.count_if(F.col("there") != F.col("is_test")).alias("rows_moved"))


def q_content_digest(spark, sf):
    return identity.content_digest(r_valid(spark, sf), "k")


def q_content_digest_texts(spark, sf):
    return identity.content_digest(e_valid(spark, sf), "k")


def q_union_chunks_digest(spark, sf):
    """The chunks cleaned one by one, united and cleaned again have the digest of the whole."""
    raw = e_raw(spark, sf)
    chunks = validate.validated(raw, "k", "target", ["ord"], e_rule, by=["chunk"])
    united = validate.keep_first(chunks, "k", ["ord"])
    return identity.content_digest(united, "k")


def q_seeded_sample(spark, sf):
    return sampling.seeded_sample(table(spark, sf, "orders"), "o_orderkey", SAMPLE_ROWS).select(
        "o_orderkey", "o_totalprice"
    )


def q_disjoint_halves(spark, sf):
    first, second = sampling.disjoint_halves(table(spark, sf, "orders"), "o_orderkey", HALF_ROWS)
    return first.withColumn("half", F.lit(1)).unionByName(second.withColumn("half", F.lit(2))).select(
        "o_orderkey", "half"
    )


def q_halves_overlap(spark, sf):
    """Keys in both halves, and sample keys in neither: none."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    first, second = sampling.disjoint_halves(orders, "o_orderkey", HALF_ROWS)
    sample = sampling.seeded_sample(orders, "o_orderkey", 2 * HALF_ROWS)
    both = first.intersect(second).withColumn("what", F.lit("in both halves"))
    lost = sample.exceptAll(first.unionByName(second)).withColumn("what", F.lit("in neither half"))
    found = both.unionByName(lost).groupBy("what").agg(F.count("*").alias("n_rows"))
    what = spark.createDataFrame([("in both halves",), ("in neither half",)], "what string")
    return what.join(found, "what", "left").select("what", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def q_sequential_chunks(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ord"))
    return sampling.sequential_chunks(orders, "ord", SLICE_ROWS)


def _arrivals(spark, sf):
    raw = e_raw(spark, sf)
    return raw.filter("chunk = 3"), raw.filter("chunk <> 3")


def q_novel_rows(spark, sf):
    incoming, reference = _arrivals(spark, sf)
    return novelty.novel_rows(incoming, reference, "k", True, e_rule).select("ord", F.md5("k").alias("raw_md5"))


def q_known_rows(spark, sf):
    incoming, reference = _arrivals(spark, sf)
    return novelty.known_rows(incoming, reference, "k", True, e_rule).select("ord", F.md5("k").alias("raw_md5"))


def q_novelty_facts(spark, sf):
    incoming, reference = _arrivals(spark, sf)
    return novelty.novelty_facts(incoming, reference, "k", True, e_rule)


def _grown_index(spark, sf):
    """The reference chunks appended one after another to an index of keys."""
    index = KeyIndex(spark, scratch_dir(spark, "key-index"), 16, True, e_rule)
    _, reference = _arrivals(spark, sf)
    for chunk in range(3):
        index.append(f"chunk {chunk}", reference.filter(F.col("chunk") == chunk), "k")
    return index


def q_novelty_index(spark, sf):
    """An arriving chunk against keys stored by the chunks before it."""
    return _grown_index(spark, sf).novelty_facts(_arrivals(spark, sf)[0], "k")


def q_novel_rows_index(spark, sf):
    return _grown_index(spark, sf).novel_rows(_arrivals(spark, sf)[0], "k").select("ord", F.md5("k").alias("raw_md5"))


def q_novelty_facts_raw(spark, sf):
    """Lines against lines by raw key: returned items arrive, the others are the reference."""
    lines = r_raw(spark, sf).select("k", "l_returnflag")
    return novelty.novelty_facts(
        lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag <> 'R'"), "k"
    )


def q_retrain_rule(spark, sf):
    """Advice on each return flag's lines against the other flags', with and without a champion."""
    lines = r_raw(spark, sf).select("k", "l_returnflag")
    advice = None
    for flag, champion in (("A", True), ("N", True), ("R", False)):
        facts = novelty.novelty_facts(
            lines.filter(F.col("l_returnflag") == flag), lines.filter(F.col("l_returnflag") != flag), "k"
        )
        one = novelty.retrain_rule(facts, 0.5, F.lit(champion)).select(
            F.lit(flag).alias("chunk"), "novel_fraction", "retrain", "reason"
        )
        advice = one if advice is None else advice.unionByName(one)
    return advice


def q_fingerprint_bits(spark, sf):
    bits = e_valid(spark, sf).select("ord", fingerprint_bits(F.split("k", " "), 2, 2048).alias("bits"))
    return bits.select("ord", F.size("bits").cast("bigint").alias("n_bits"), F.array_join("bits", ",").alias("bits"))


def q_bit_frequency(spark, sf):
    bits = e_valid(spark, sf).select(F.explode(fingerprint_bits(F.split("k", " "), 2, 2048)).alias("bit"))
    return bits.groupBy(F.col("bit").cast("bigint").alias("bit")).agg(F.count("*").alias("n_rows"))


def q_params_hash(spark, sf):
    params = F.create_map(
        F.lit("user"), F.col("user_id").cast("string"),
        F.lit("props"), F.col("props"),
        F.lit("kind"), F.col("event_type"),
    )
    return table(spark, sf, "events").select("event_id", identity.params_hash(params).alias("params_hash"))


def _lane_sql(column: str) -> str:
    words = [f"('0x' || substr(sha256({column}), {1 + 15 * i}, 15))::BIGINT" for i in range(4)]
    lanes = [f"CAST(sum(({w} >> {shift}) & 1048575) AS BIGINT)" for w in words for shift in (40, 20, 0)]
    return f"count(*) AS n_keys, sha256(concat_ws(':', count(*), {', '.join(lanes)})) AS content_digest"


def _round_sql(r: int) -> str:
    order = "(PARTITION BY ord ORDER BY i)"
    return f"""round{r} AS (SELECT ord, i, (coalesce(lag(id) OVER {order}, 0) * {LEFT} + id * {SELF}
  + coalesce(lead(id) OVER {order}, 0) * {RIGHT} + {r * STEP}) % {PRIME} AS id FROM round{r - 1})"""


_PICK = """md5('7:' || o_orderkey), o_orderkey"""
_FINGERPRINT = f""",
words AS (SELECT ord, string_split(k, ' ') AS t FROM e_valid),
places AS (SELECT ord, unnest(t) AS word, generate_subscripts(t, 1) AS i FROM words),
round0 AS (SELECT ord, i, ('0x' || substr(md5(word), 1, 8))::BIGINT % {PRIME} AS id FROM places),
{_round_sql(1)},
{_round_sql(2)},
bits AS (SELECT DISTINCT ord, id % 2048 AS bit FROM (
  SELECT ord, id FROM round0 UNION ALL SELECT ord, id FROM round1 UNION ALL SELECT ord, id FROM round2))"""
_LINES = "WITH lines AS (SELECT l_orderkey || ':' || l_linenumber AS k, l_returnflag AS f FROM lineitem)"


def _fact_sql(flag: str) -> str:
    return f"""SELECT '{flag}' AS chunk, count(*) AS n,
  count(*) FILTER (k NOT IN (SELECT k FROM lines WHERE f <> '{flag}')) AS novel FROM lines WHERE f = '{flag}'"""


QUERIES = {
    "read_chunk": (q_read_chunk, """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
        o_orderpriority FROM orders"""),
    "arrival_digest": (q_arrival_digest, None),
    "distinct_arrivals": (q_distinct_arrivals, None),
    "drop_null_rows": (q_drop_null_rows, f"""WITH {E_RAW} SELECT ord, md5(raw) AS key_md5, target FROM e_raw
        WHERE raw IS NOT NULL AND target IS NOT NULL"""),
    "canonical_key": (q_canonical_key, f"WITH {E_RAW} SELECT ord, k FROM e_key"),
    "drop_unparseable": (q_drop_unparseable, f"""WITH {E_RAW} SELECT ord, md5(k) AS key_md5, target FROM e_key
        WHERE target IS NOT NULL AND k IS NOT NULL"""),
    "validated_frame": (q_validated_frame, f"WITH {E_VALID} SELECT ord, k, target, source FROM e_valid"),
    "validated_lines": (q_validated_lines, f"WITH {R_VALID} SELECT k, target, l_quantity, l_returnflag FROM r_valid"),
    "dedup_keep_first": (q_dedup_keep_first, f"WITH {R_VALID} SELECT k, l_partkey, l_suppkey, target FROM r_valid"),
    "duplicate_rows": (q_duplicate_rows, f"""WITH {R_VALID} SELECT k, l_partkey, l_suppkey, target,
        count(*) OVER (PARTITION BY k) AS copies FROM r_raw QUALIFY copies > 1"""),
    "validation_report": (q_validation_report, f"""WITH {E_RAW},
        t AS (SELECT count(*) AS raw_rows, count(*) FILTER (raw IS NULL OR target IS NULL) AS null_rows,
          count(*) FILTER (raw IS NOT NULL AND target IS NOT NULL AND k IS NULL) AS unparseable_rows,
          count(k) FILTER (target IS NOT NULL) AS parsed,
          count(DISTINCT k) FILTER (target IS NOT NULL) AS valid_rows FROM e_key)
        SELECT raw_rows, null_rows, unparseable_rows, parsed - valid_rows AS duplicate_rows, valid_rows,
          raw_rows - valid_rows AS dropped_rows FROM t"""),
    "train_split": (q_train_split, f"WITH {E_SPLIT} SELECT ord, md5(k) AS key_md5, target FROM e_split WHERE NOT is_test"),
    "test_split": (q_test_split, f"WITH {E_SPLIT} SELECT ord, md5(k) AS key_md5, target FROM e_split WHERE is_test"),
    "split_stability": (q_split_stability, f"""WITH {E_RAW} SELECT count(*) AS rows_compared,
        CAST(0 AS BIGINT) AS rows_moved FROM (SELECT DISTINCT chunk, k FROM e_key
        WHERE raw IS NOT NULL AND target IS NOT NULL AND k IS NOT NULL)"""),
    "content_digest": (q_content_digest, f"WITH {R_VALID} SELECT {_lane_sql('k')} FROM r_valid"),
    "content_digest_texts": (q_content_digest_texts, f"WITH {E_VALID} SELECT {_lane_sql('k')} FROM e_valid"),
    "union_chunks_digest": (q_union_chunks_digest, f"WITH {E_VALID} SELECT {_lane_sql('k')} FROM e_valid"),
    "seeded_sample": (q_seeded_sample, f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_PICK} LIMIT {SAMPLE_ROWS}"),
    "disjoint_halves": (q_disjoint_halves, f"""SELECT o_orderkey, CAST(CASE WHEN rn <= {HALF_ROWS} THEN 1 ELSE 2 END AS INTEGER) AS half
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {_PICK}) AS rn FROM orders) WHERE rn <= {2 * HALF_ROWS}"""),
    "halves_overlap": (q_halves_overlap, f"""WITH ranked AS (
          SELECT o_orderkey, row_number() OVER (ORDER BY {_PICK}) AS rn FROM orders),
        a AS (SELECT o_orderkey FROM ranked WHERE rn <= {HALF_ROWS}),
        b AS (SELECT o_orderkey FROM ranked WHERE rn > {HALF_ROWS} AND rn <= {2 * HALF_ROWS}),
        s AS (SELECT o_orderkey FROM ranked WHERE rn <= {2 * HALF_ROWS})
        SELECT 'in both halves' AS what, count(*) AS n_rows FROM a JOIN b USING (o_orderkey)
        UNION ALL SELECT 'in neither half', count(*) FROM s
          WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a UNION ALL SELECT o_orderkey FROM b)"""),
    "sequential_chunks": (q_sequential_chunks, f"""SELECT o_orderkey AS ord,
        (row_number() OVER (ORDER BY o_orderkey) - 1) // {SLICE_ROWS} AS chunk FROM orders"""),
    "novel_rows": (q_novel_rows, f"""WITH {E_RAW} SELECT ord, md5(raw) AS raw_md5 FROM e_key WHERE chunk = 3
        AND k IS NOT NULL AND k NOT IN (SELECT k FROM e_key WHERE chunk <> 3 AND k IS NOT NULL)"""),
    "known_rows": (q_known_rows, f"""WITH {E_RAW} SELECT ord, md5(raw) AS raw_md5 FROM e_key WHERE chunk = 3
        AND k IN (SELECT k FROM e_key WHERE chunk <> 3 AND k IS NOT NULL)"""),
    "novelty_facts": (q_novelty_facts, f"""WITH {E_RAW},
        i AS (SELECT k IN (SELECT k FROM e_key WHERE chunk <> 3 AND k IS NOT NULL) AS known
          FROM e_key WHERE chunk = 3)
        SELECT count(*) AS incoming_rows, count(*) FILTER (NOT known) AS novel_rows,
          round(count(*) FILTER (NOT known) / greatest(count(*), 1), 4) AS novel_fraction,
          (SELECT count(*) FROM e_key WHERE chunk <> 3) AS reference_rows FROM i"""),
    "novelty_facts_raw": (q_novelty_facts_raw, f"""{_LINES}, t AS ({_fact_sql('R')})
        SELECT n AS incoming_rows, novel AS novel_rows, round(novel / greatest(n, 1), 4) AS novel_fraction,
          (SELECT count(*) FROM lines WHERE f <> 'R') AS reference_rows FROM t"""),
    "retrain_rule": (q_retrain_rule, f"""{_LINES}, t AS (
          {_fact_sql('A')} UNION ALL {_fact_sql('N')} UNION ALL {_fact_sql('R')}),
        s AS (SELECT chunk, chunk <> 'R' AS champion, round(novel / greatest(n, 1), 4) AS novel_fraction FROM t)
        SELECT chunk, novel_fraction, NOT champion OR novel_fraction >= 0.5 AS retrain,
          CASE WHEN NOT champion THEN 'no champion yet'
            WHEN novel_fraction >= 0.5 THEN 'novel fraction ' || printf('%.4f', novel_fraction) || ' reaches 0.5'
            ELSE 'novel fraction ' || printf('%.4f', novel_fraction) || ' is below 0.5' END AS reason FROM s"""),
    "fingerprint_bits": (q_fingerprint_bits, f"""WITH {E_VALID}{_FINGERPRINT}
        SELECT ord, count(*) AS n_bits, string_agg(bit, ',' ORDER BY bit) AS bits FROM bits GROUP BY ord"""),
    "bit_frequency": (q_bit_frequency, f"""WITH {E_VALID}{_FINGERPRINT}
        SELECT bit, count(*) AS n_rows FROM bits GROUP BY bit"""),
    "params_hash": (q_params_hash, """SELECT event_id, sha256(
        to_json({'k': 'kind', 'v': event_type}) || ',' || to_json({'k': 'props', 'v': props}) || ',' ||
        to_json({'k': 'user', 'v': CAST(user_id AS VARCHAR)})) AS params_hash FROM events"""),
}
QUERIES |= {
    "distinct_texts": (q_distinct_texts, LANDED_TEXTS),
    "dropped_rows": (q_dropped_rows, QUERIES["validation_report"][1]),
    "novelty_index": (q_novelty_index, QUERIES["novelty_facts"][1]),
    "novel_rows_index": (q_novel_rows_index, QUERIES["novel_rows"][1]),
}
