import pytest
from pyspark.errors import StreamingQueryException

from wardline.sources import layers
from wardline.streaming.raw_feed import feed_bronze


def test_only_new_parts_are_appended(spark, tmp_path):
    parts = tmp_path / "raw" / "conditions.csv"
    parts.mkdir(parents=True)
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def run():
        feed_bronze(spark, str(parts), bronze, checkpoint).awaitTermination()
        rows = layers.read_table(spark, bronze, "conditions").collect()
        return sorted(map(tuple, rows), key=str)

    (parts / "part-0.csv").write_text('CODE,NOTE\n007,"a\nb"\n')
    assert run() == [("007", "a\nb")]
    assert run() == [("007", "a\nb")]
    (parts / "part-1.csv").write_text("CODE,NOTE\n8,\n")
    assert run() == [("007", "a\nb"), ("8", None)]
    (parts / "part-2.csv").write_text("NOTE,CODE\nx,9\n")
    with pytest.raises(StreamingQueryException):
        run()


def test_nothing_to_feed(spark, tmp_path):
    (tmp_path / "x.csv").mkdir()
    with pytest.raises(ValueError):
        feed_bronze(spark, str(tmp_path / "x.csv"), str(tmp_path), str(tmp_path / "c"))
