import random

from pyspark.sql import functions as F

from demandloom.llm.common import fit_in_task, running_total, text_slices, word_count


def test_running_total_over_buckets(spark):
    draw = random.Random(6)
    rows = [(draw.choice("ab"), draw.randint(0, 4), i, draw.randint(0, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, b int, i int, v long")
    found = {r.i: r.total for r in running_total(df, ["g"], "b", [F.col("i")], F.col("v"), "total").collect()}
    for by in (["g"], []):
        found = {r.i: r.total for r in running_total(df, by, "b", [F.col("i")], F.col("v"), "total").collect()}
        ordered = sorted(rows, key=lambda r: (r[0] if by else "", r[1], r[2]))
        sums, wanted = {}, {}
        for g, _, i, v in ordered:
            key = g if by else ""
            wanted[i] = sums.get(key, 0)
            sums[key] = wanted[i] + v
        assert found == wanted


def test_word_count(spark):
    texts = [None, "", " \t\n", "one", " a\u0085b\x0bc  d\x1ce "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(word_count(F.col("t")).alias("n")).collect()] == [0, 0, 0, 1, 3]


def test_slices_keep_all_rows_and_their_order():
    import pyarrow as pa

    texts = ["x" * n for n in (5, 0, 100, 3, 3, 3)] + [None, "y"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    parts = [p.column("text").to_pylist() for p in text_slices(batch, "text", 10)]
    assert [t for p in parts for t in p] == texts
    assert [len(p) for p in parts] == [2, 1, 5]


def test_a_fit_sees_its_rows_in_order_and_works_without_rows(spark):
    rows = spark.range(0, 500, numPartitions=7).select((F.col("id") * 7 % 500).alias("k"))
    assert fit_in_task(rows, [F.col("k")], lambda t: t.column("k").to_pylist()) == list(range(500))
    assert fit_in_task(rows.limit(0), [F.col("k")], lambda t: t.num_rows) == 0
