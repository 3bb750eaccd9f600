import pytest
from pyspark.sql import functions as F

from tsubo.plans import prepared
from tsubo.sources import staging, tables


def test_csv_keeps_awkward_text_and_the_byte_order_mark(spark, tmp_path):
    path = str(tmp_path / "csv")
    data = [("a,\"b\"", 1.5), ("line\nbreak", None), (" blanks ", 0.1), (None, 2.0), ("", 3.0), ("\\", 1e-17), ("line\r\nbreak", 4.0)]
    df = spark.createDataFrame(data, "title STRING, rent DOUBLE").coalesce(1)
    tables.write_csv(df, path, byte_order_mark=True)
    first = next((tmp_path / "csv").glob("part-*.csv")).read_bytes()
    assert first.startswith(b"\xef\xbb\xbftitle,rent")
    back = tables.read_csv(spark, path, "title STRING, rent DOUBLE", multi_line=True)
    expected = [(title or None, rent) for title, rent in data]
    assert sorted(map(str, (tuple(r) for r in back.collect()))) == sorted(map(str, expected))


def test_csv_without_a_byte_order_mark_reads_empty_as_missing(spark, tmp_path):
    (tmp_path / "x.csv").write_text("title,rent\n,1\nb,\n", encoding="utf-8")
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "x.csv"), "title STRING, rent DOUBLE").collect()] == [(None, 1.0), ("b", None)]


def test_table_and_view_are_replaced(spark, tmp_path):
    for rows, path in ((3, "a"), (5, "b")):
        assert tables.write_table(spark.range(rows).toDF("n"), "replaced", str(tmp_path / path)).count() == rows
        assert tables.create_view(spark.range(rows), "seen").count() == rows
    assert spark.sql("SELECT * FROM seen").count() == 5
    other = tables.write_table(spark.range(2).selectExpr("id AS other"), "replaced", str(tmp_path / "c"))
    assert other.columns == ["other"]


def test_page_files_and_batches(spark, tmp_path):
    (tmp_path / "1.html").write_text("<p>\nwhole\n</p>", encoding="utf-8")
    found = tables.read_page_files(spark, str(tmp_path))
    assert [r["html"] for r in found.collect()] == ["<p>\nwhole\n</p>"]
    assert tables.append_pages(found, found).count() == 2


def test_stage_writes_to_the_shared_folder(spark):
    staged = staging.stage(spark.range(10), "ten")
    assert staged.count() == 10
    assert staging.shared_folder(spark) in staged.inputFiles()[0]


def test_every_session_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError):
        staging.shared_folder(Session())


def test_prepared_tables_follow_their_input(spark, tmp_path):
    tables.read_table(spark, "/root/testdata/sf0.001", "lineitem").limit(50).write.parquet(str(tmp_path / "lineitem.parquet"))
    first = prepared.standard(spark, str(tmp_path))
    assert prepared.standard(spark, str(tmp_path)).inputFiles() == first.inputFiles()
    tables.read_table(spark, "/root/testdata/sf0.001", "lineitem").limit(80).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    again = prepared.standard(spark, str(tmp_path))
    assert again.inputFiles() != first.inputFiles() and again.count() > first.count()
    prepared.forget(spark)
    assert prepared.standard(spark, str(tmp_path)).inputFiles() != again.inputFiles()


def direct_bytes(spark):
    """Memory of the JVM's direct buffers."""
    jvm = spark.sparkContext._jvm
    pools = jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean"))
    return sum(p.getMemoryUsed() for p in pools if p.getName() == "direct")


def test_reading_leaves_no_buffers(spark, tmp_path):
    """Vectored reads left one of 14 MB here, the size of the column chunk, and one more in every thread that met one."""
    wide = spark.range(14 << 10).coalesce(1).select(F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(16)), lambda i: F.sha2(F.concat_ws("-", "id", i), 256))).alias("text"))
    written = staging.stage(wide, "wide")
    wide.write.option("parquet.block.size", 64 << 20).parquet(str(tmp_path / "wide"))
    before = direct_bytes(spark)
    assert written.agg(F.sum(F.length("text"))).first()[0] == 14 << 20
    assert direct_bytes(spark) - before < 4 << 20
    setting = spark.conf.get(staging.VECTORED_READS, None)
    try:
        staging.plain_reads(spark)
        assert spark.read.parquet(str(tmp_path / "wide")).agg(F.sum(F.length("text"))).first()[0] == 14 << 20
        assert direct_bytes(spark) - before < 4 << 20
    finally:
        spark.conf.unset(staging.VECTORED_READS) if setting is None else spark.conf.set(staging.VECTORED_READS, setting)
