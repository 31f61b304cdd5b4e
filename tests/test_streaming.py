from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallybook.operators import allocation as A
from tallybook.sources import messages as MSG
from tallybook.sources import readers as R
from tallybook.sources import sinks as S
from tallybook.streaming import polarity as P
from tallybook.streaming.allocate import allocate_stream
from tests.test_operators import by_hand, market_frames, small_market

TEXTS = ["Good day, good people!", "bad bad luck", "so-so", "Good but bad", "", "nice, very nice", "awful..."]


def words(spark, text):
    return spark.createDataFrame([(w,) for w in text.split()], "word string")


def messages(spark):
    rows = [(datetime(2024, 1, 1) + timedelta(seconds=4 * i), v) for i, v in enumerate(TEXTS)]
    return spark.createDataFrame(rows, MSG.SCHEMA)


def lexicons(spark):
    return words(spark, "good nice but"), words(spark, "bad awful but")


def test_counts(spark):
    got = dict(map(tuple, P.polarity_counts(messages(spark), *lexicons(spark)).collect()))
    assert got == {"positive": 6, "negative": 5}


def test_windowed_stream_equals_batch(spark, folder):
    MSG.write_messages(messages(spark).repartition(3), "parquet", f"{folder}/in")
    feed = MSG.read_messages(spark, "parquet", f"{folder}/in", maxFilesPerTrigger="1")
    pos, neg = lexicons(spark)
    q = (
        P.polarity_counts(feed, pos, neg, window="10 seconds", late="1 hour")
        .writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", f"{folder}/chk").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    want = sorted(map(tuple, P.polarity_counts(messages(spark), pos, neg, window="10 seconds").collect()))
    assert sorted(map(tuple, spark.table("windows").collect())) == want


def test_recorded_batches_and_restart(spark, folder):
    pos, neg = lexicons(spark)
    for part in (messages(spark).limit(3), messages(spark).exceptAll(messages(spark).limit(3))):
        MSG.write_messages(part, "parquet", f"{folder}/in")
        feed = MSG.read_messages(spark, "parquet", f"{folder}/in")
        P.record_batches(feed, pos, neg, f"{folder}/out", f"{folder}/chk", interval=None).awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    assert dict(map(tuple, out.groupBy("polarity").agg(F.sum("cnt")).collect())) == {"positive": 6, "negative": 5}
    assert out.select("batch_id").distinct().count() == 2


def test_run_for_stops(spark, folder):
    MSG.write_messages(messages(spark), "parquet", f"{folder}/in")
    feed = MSG.read_messages(spark, "parquet", f"{folder}/in")
    q = MSG.start(feed, "noop", f"{folder}/chk", interval="1 second")
    P.run_for(q, 3)
    assert not q.isActive


def test_series_fills_gaps(spark):
    counts = spark.createDataFrame([(100, "positive", 3), (100, "negative", 1), (130, "positive", 2), (130, "negative", 2)], "start long, polarity string, cnt long")
    got = sorted(map(tuple, P.polarity_series(counts).collect()))
    assert got == [(0, 3, 1), (1, 0, 0), (2, 0, 0), (3, 2, 2)]


def test_stream_sink(spark, folder):
    MSG.write_messages(messages(spark), "parquet", f"{folder}/in")
    feed = MSG.read_messages(spark, "parquet", f"{folder}/in")
    MSG.write_messages(feed, "parquet", f"{folder}/copy", checkpoint=f"{folder}/chk").awaitTermination()
    assert spark.read.parquet(f"{folder}/copy").count() == len(TEXTS)


def test_allocation_stream_equals_log(spark, folder):
    log, bids, budgets = small_market(17, 120)
    q, b, u = market_frames(spark, log, bids, budgets)
    for low, high in ((1, 60), (61, 120)):  # two files, taken in order of arrival
        q.where(F.col("seq").between(low, high)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    comp = b.select("keyword", F.lit(0).cast("bigint").alias("comp")).distinct()
    for policy in ("greedy", "msvv"):
        feed = spark.readStream.schema("seq long, keyword string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        run = allocate_stream(feed, b, u, policy, comp)
        w = run.writeStream.format("memory").queryName(f"won_{policy}").option("checkpointLocation", f"{folder}/chk-{policy}").trigger(availableNow=True).start()
        w.awaitTermination()
        got = [tuple(r) for r in spark.table(f"won_{policy}").orderBy("seq").select("seq", "adv_id", "bid").collect()]
        assert got == by_hand(log, bids, budgets, policy)


def test_walk_files_are_reused(spark, folder):
    rows = [(n, r, [str(n), "x"]) for n in range(3) for r in (1, 2)]
    walks = spark.createDataFrame(rows, "start long, rep long, path array<string>")
    S.write_walks(walks, folder, always_rebuild=False, expected=3)
    S.write_walks(walks.withColumn("path", F.array(F.lit("new"))), folder, always_rebuild=False, expected=3)
    assert {tuple(r["path"]) for r in R.read_walks(spark, folder).select("path").collect()} == {(str(n), "x") for n in range(3)}
    S.write_walks(walks.withColumn("path", F.array(F.lit("new"))), folder)
    assert {tuple(r["path"]) for r in R.read_walks(spark, folder).select("path").collect()} == {("new",)}


def test_communities_in_chunks(spark, folder):
    comm = spark.createDataFrame([(i, i % 3) for i in range(12)], "id long, comm long")
    S.write_communities(comm, f"{folder}/a")
    assert sorted(map(tuple, R.read_communities(spark, f"{folder}/a").collect())) == sorted((i, i % 3) for i in range(12))
    S.write_communities(comm, f"{folder}/b", chunk=2)
    assert spark.read.text(f"{folder}/b").count() == 6
    assert sorted(map(tuple, R.read_communities(spark, f"{folder}/b").collect())) == sorted((i, i % 3) for i in range(12))
    spark.createDataFrame([("1, 2",), ("3",)], "value string").coalesce(1).write.text(f"{folder}/c")
    assert sorted(map(tuple, R.read_communities(spark, f"{folder}/c").collect())) == [(1, 0), (2, 0), (3, 1)]


def test_single_file_logs(spark, folder):
    with open(f"{folder}/q.txt", "w") as f:
        f.write("houston rockets \nlucius review\n houston rockets\n")
    got = [tuple(r) for r in R.read_query_lines(spark, f"{folder}/q.txt").orderBy("seq").collect()]
    assert got == [(0, "houston rockets"), (1, "lucius review"), (2, "houston rockets")]
    with open(f"{folder}/adj.txt", "w") as f:
        f.write("# comment\n1 2 3\n2 1\n4\n")
    got = sorted(map(tuple, R.read_adjacency(spark, f"{folder}/adj.txt").collect()))
    assert got == [("1", "2"), ("1", "3"), ("2", "1")]


def test_malformed_rows(spark, folder):
    with open(f"{folder}/p.txt", "w") as f:
        f.write("1 2 3\n1 x 3\n")
    try:
        R.read_plays(spark, f"{folder}/p.txt").collect()
        raise AssertionError("a malformed row must fail the read")
    except AssertionError:
        raise
    except Exception:
        pass
    kept = R.read_plays(spark, f"{folder}/p.txt", mode="PERMISSIVE").cache()
    assert kept.where("_corrupt_record IS NULL").count() == 1 and kept.count() == 2


def test_experiment_greedy_uses_rounds(spark):
    q, b, u = market_frames(spark, *small_market(18, 80))
    assert A.experiment(q, b, u, "greedy", trials=2).select("trial").distinct().count() == 2
