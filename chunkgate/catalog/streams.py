"""Queries that run Structured Streaming over the given tables' files."""

from __future__ import annotations

from pyspark.sql import functions as F

from chunkgate.catalog.bindings import LANDED_TEXTS, R_ORDER, l_runs, landed_texts, r4, r_raw, table, table_file
from chunkgate.catalog.registers import PENDING_SQL
from chunkgate.operators import ledger, models, score
from chunkgate.operators.validate import validated
from chunkgate.session import scratch_dir
from chunkgate.streaming.arrivals import append_stream, stream_arrivals, stream_distinct_arrivals
from chunkgate.streaming.watch import for_each_batch, new_files

SEGMENT_ROWS = 20


def _collected(spark, rows, label):
    out, checkpoint = scratch_dir(spark, label), scratch_dir(spark, f"{label}-state")
    append_stream(rows, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def _named(rows):
    return rows.select(table_file("path").alias("file_name"), "length", "digest")


def q_stream_arrivals(spark, sf):
    return _named(_collected(spark, stream_arrivals(spark, sf, "*.parquet", recursive=True), "arrivals"))


def q_stream_distinct_arrivals(spark, sf):
    arrivals = stream_distinct_arrivals(stream_arrivals(spark, sf, "*.parquet", recursive=True))
    return _named(_collected(spark, arrivals, "distinct-arrivals"))


def q_stream_distinct_texts(spark, sf):
    """Text files of which two are equal, streamed two at a time: each content once, by digest."""
    landing = landed_texts(spark, scratch_dir(spark, "texts"), sf)
    arrivals = stream_distinct_arrivals(stream_arrivals(spark, landing, "*.txt", 2, recursive=True))
    return _collected(spark, arrivals, "distinct-texts").select("length", "digest")


def q_stream_path_order(spark, sf):
    """Files that land in descending order of their paths, and one landed twice, are taken up by path and once."""
    landing, out, state = (scratch_dir(spark, name) for name in ("landing", "taken", "taken-state"))
    events = table(spark, sf, "events").select("event_type", "event_id", "value")
    kinds = sorted((r[0] for r in events.select("event_type").distinct().collect()), reverse=True)
    for kind in [*kinds, kinds[0]]:
        write_once = events.where(F.col("event_type") == kind).orderBy("event_id").coalesce(1).write
        write_once.mode("append").csv(f"{landing}/{kind}", header=True)  # the first kind twice: two files of the same bytes

    def work(batch, batch_id):
        for place, row in enumerate(new_files(batch, batch_id, f"{state}/seen-files"), 1):
            rows = spark.read.csv(row["path"], header=True, schema="event_type string, event_id long, value double")
            facts = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("sum_ids"))
            facts.select(F.lit(place).cast("long").alias("place"), "*").write.mode("overwrite").parquet(f"{out}/batch={batch_id}/place={place}")

    arrivals = stream_arrivals(spark, landing, "*.csv", recursive=True)
    for_each_batch(arrivals, work, f"{state}/stream").awaitTermination()
    return spark.read.option("recursiveFileLookup", True).parquet(out).select("place", "event_type", "n_rows", "sum_ids")


def q_stream_pending(spark, sf):
    """Arrivals streamed from the ledger's files and checked, batch by batch, against finished runs."""
    schema = table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{sf}/events.parquet")
    runs = l_runs(spark, sf)
    out, checkpoint = scratch_dir(spark, "pending"), scratch_dir(spark, "pending-state")

    def work(batch, batch_id):
        arrivals = batch.select(
            F.md5(F.concat_ws(":", "user_id", "props")).alias("raw_data_hash"),
            F.concat(F.lit("chunk-"), F.col("user_id"), F.lit(".csv")).alias("raw_path"),
        )
        distinct = arrivals.groupBy("raw_data_hash").agg(F.min("raw_path").alias("raw_path"))
        ledger.pending_arrivals(distinct, runs).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for_each_batch(events, work, checkpoint).awaitTermination()
    return spark.read.parquet(out).groupBy("raw_data_hash").agg(F.min("raw_path").alias("raw_path"))


def q_stream_score(spark, sf):
    """Lines land as one chunk for each shipping year; every arrival is validated, scored and ranked."""
    landing, notices = scratch_dir(spark, "landing"), scratch_dir(spark, "notices")
    out, checkpoint = scratch_dir(spark, "scored"), scratch_dir(spark, "scored-state")
    raw = r_raw(spark, sf).withColumn("year", F.year("l_shipdate"))
    raw.write.partitionBy("year").parquet(landing)
    years = spark.read.parquet(landing).groupBy("year").agg(F.count("*").alias("landed_rows"))
    years.repartitionByRange("year").write.json(notices)
    line = models.fit_lines(raw, "l_quantity", "target").first()
    arrivals = (
        spark.readStream.schema("year int, landed_rows bigint").option("maxFilesPerTrigger", 1).json(notices)
    )

    def work(batch, batch_id):
        named = [row["year"] for row in batch.select("year").collect()]  # those of one notice
        chunk = spark.read.parquet(landing).filter(F.col("year").isin(named))
        valid = validated(chunk, "k", "target", R_ORDER, by=["year"])
        prediction = line["intercept"] + line["slope"] * F.col("l_quantity") - 1000 * F.col("l_tax")
        scored = valid.select("year", "k", r4(prediction).alias("predicted_target"))
        best = score.shortlist_by_segment(scored, ["year"], "predicted_target", "k", SEGMENT_ROWS)
        best.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for_each_batch(arrivals, work, checkpoint).awaitTermination()
    found = spark.read.parquet(out)
    return found.select(
        F.col("year").cast("bigint").alias("year"), "k", "predicted_target", F.col("rank").cast("bigint").alias("rank")
    )


QUERIES = {
    "stream_distinct_texts": (q_stream_distinct_texts, f"SELECT length, digest FROM ({LANDED_TEXTS})"),
    "stream_path_order": (q_stream_path_order, """SELECT row_number() OVER (ORDER BY event_type) AS place, event_type, count(*) AS n_rows,
        CAST(sum(event_id) AS BIGINT) AS sum_ids FROM events GROUP BY event_type"""),
    "stream_arrivals": (q_stream_arrivals, None),
    "stream_distinct_arrivals": (q_stream_distinct_arrivals, None),
    "stream_pending": (q_stream_pending, PENDING_SQL),
    "stream_score": (q_stream_score, f"""WITH r AS (
          SELECT year(l_shipdate) AS year, l_orderkey || ':' || l_linenumber AS k, l_extendedprice AS target, * FROM lineitem),
        f AS (SELECT covar_pop(target, l_quantity) * count(*) / (var_pop(l_quantity) * count(*) + 1.0) AS slope,
          avg(l_quantity) AS mean_x, avg(target) AS mean_target FROM r),
        v AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY year, k
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1),
        s AS (SELECT year, k, round(mean_target - slope * mean_x + slope * l_quantity - 1000 * l_tax, 4)
          AS predicted_target FROM v, f)
        SELECT *, row_number() OVER (PARTITION BY year ORDER BY predicted_target, k) AS rank FROM s
        QUALIFY rank <= {SEGMENT_ROWS}"""),
}
