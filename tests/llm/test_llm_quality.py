import random

from pyspark.sql import functions as F

from wardline.llm import quality
from wardline.llm.queries import held_out


def text(seed, good):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ter", "lon", "mar", "vel", "sin") for b in ("a", "ok", "in", "est", "or")]
    if good:
        return " ".join(rng.choice(words) for _ in range(60)).capitalize() + "."
    return " | ".join(rng.choice(words).upper() + "!!" for _ in range(60))


def labelled(spark, n=400):
    rows = [(i, text(i, i % 4 != 0), int(i % 4 != 0)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string, label int").withColumn("h", F.xxhash64("id"))


def test_held_out_accuracy(spark):
    rows = labelled(spark)
    model = quality.fit(rows.where("id % 5 <> 0"))
    scored = rows.where("id % 5 = 0").withColumn("score", quality.score_column(model, F.col("text"))).collect()
    assert all(0 <= r.score <= 1 for r in scored)
    right = sum((r.score >= 0.7) == (r.label == 1) for r in scored)
    assert right >= 0.97 * len(scored)


def test_sample_is_bounded_and_the_same_each_time(spark):
    marks = labelled(spark).select("id", "label")
    some = sorted(quality.sample_ids(marks, 20).collect())
    assert len(some) == 40 and some == sorted(quality.sample_ids(marks.repartition(7), 20).collect())


def test_odd_rows_and_columns(spark, make_docs, odd_rows, clash):
    model = quality.fit(labelled(spark))
    docs = clash(make_docs(odd_rows))
    kept = quality.keep_good(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows)
    assert quality.keep_good(docs, model, 1.1).count() == 0
    assert quality.keep_good(make_docs([]), model, 0.0).count() == 0
    empty = model.scorer()(["", None])
    assert empty[0] == empty[1] and 0 <= empty[0] <= 1


def test_excerpts_come_from_the_whole_text():
    lines = [f"line {i} " + "x" * (i % 50) for i in range(2000)]
    text = "\n".join(lines)
    some = quality.excerpt(text, 8192)
    picked = some.split("\n")
    assert 7000 < len(some) <= 8192 + 60 and [x for x in lines if x in set(picked)] == picked
    assert sum(lines.index(x) > 1000 for x in picked) > 50  # also from the end
    assert quality.excerpt("\n".join(reversed(lines)), 8192).split("\n") == picked[::-1]
    assert quality.excerpt("short\n\ntext", 8192) == "short\n\ntext"
    assert 6000 < len(quality.excerpt("y" * 100_000, 8192)) <= 8192 + 60
    assert len(quality.excerpt("\n" * 100_000, 8192)) <= 8192


def test_rows_of_one_id_count_once(spark):
    rows = labelled(spark)
    many = rows.unionByName(rows.where("id = 8").crossJoin(spark.range(3000).select()))
    assert quality.fit(many) == quality.fit(rows)


def test_nothing_to_learn_from(spark):
    none = labelled(spark).where("false")
    assert list(quality.fit(none).scorer()(["a", None])) == [0.5, 0.5]
    one = labelled(spark).where("label = 1")
    assert list(quality.fit(one).scorer()(["a"])) == [1.0]
    tiny = labelled(spark).where("id < 2")
    assert 0 <= quality.fit(tiny).scorer()(["a"])[0] <= 1


def test_fold(spark):
    import zlib

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_bad_class_of_copies(spark, make_docs):
    for copies in (1, 3):  # of one template, and of three
        rows = [(i, text(i, True) if i % 3 else text(-1 - i % copies, False), int(i % 3 > 0)) for i in range(300)]
        notice = "\nThis notice stands under every text of both classes."
        rows = [(i, t + notice, label) for i, t, label in rows]
        frame = spark.createDataFrame(rows, "id long, text string, label int").withColumn("h", F.xxhash64("id"))
        model = quality.fit(frame)
        assert model.weights
        docs = make_docs([(i, t) for i, t, _ in rows] + [(1000 + i, text(1000 + i, True) + notice) for i in range(40)])
        kept = {r.doc_id for r in quality.keep_good(docs, model, 0.7).collect()}
        good = {i for i, _, label in rows if label} | set(range(1000, 1040))
        assert len(kept - good) == 0 and len(good & kept) >= 0.97 * len(good)


def test_keeps_all_when_nothing_was_learned(spark, make_docs):
    docs = make_docs([(i, text(i, i % 2)) for i in range(8)])
    for sample in ("false", "label = 0", "label = 1"):
        assert quality.keep_good(docs, quality.fit(labelled(spark).where(sample)), 0.7).count() == 8


def test_calibration_measures_whole_texts(spark):
    rows = labelled(spark, 90).withColumn("text", F.concat("text", F.repeat(F.lit("\nmore of it"), 1000)))
    seen = []
    usual = quality._features
    quality._features = lambda np, sizes: seen.extend(sizes) or usual(np, sizes)
    try:
        quality.fit(rows, row_bytes=200)
    finally:
        quality._features = usual
    assert seen and min(raw for raw, *_ in seen) > 11_000
