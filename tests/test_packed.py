"""Text that a query writes and reads back is packed, whatever the query; the rows stay the same."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from tickweek.plans import registry
from tickweek.session import checkpoint_root, stored
from tickweek.sinks.files import write_bare_csv
from tickweek.sources.files import read_delimited

SF = "/root/testdata/sf0.001"


def test_packed_text_reads_like_plain_text(spark, scratch):
    df = spark.range(2000).select(F.concat(F.lit('a "b", '), F.col("id").cast("string")).alias("x"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    plain, packed = scratch("plain"), scratch("packed")
    write_bare_csv(df, plain)
    write_bare_csv(df, packed, packed=True)
    rows = [sorted(map(str, read_delimited(spark, p, df.schema).collect())) for p in (plain, packed)]
    assert rows[0] == rows[1] == sorted(map(str, df.collect()))
    size = {p: sum(len(open(f, "rb").read()) for f in glob.glob(f"{p}/part-*")) for p in (plain, packed)}
    assert size[packed] * 3 < size[plain]


@pytest.mark.parametrize(
    "query, folder",
    [
        ("csv_roundtrip", "bars-csv-*"),
        ("csv_spoilt_rows", "spoilt-rows-*"),
        ("text_lines", "bars-lines-*"),
        ("csv_bad_cells", "spoilt-csv-*"),
        ("table_ctas_insert", "catalog-tables-*/raw"),
        ("flat_csv_export", "flat-csv-*"),
        ("json_roundtrip", "company-json-*"),
        ("open_documents_written", "open-documents-*"),
        ("routed_rows", "routed-documents-*"),
        ("routed_rejects", "routed-documents-*"),
    ],
)
def test_round_trips_write_packed_text(spark, query, folder):
    def files():
        return set(glob.glob(f"{checkpoint_root(spark)}/tickweek/*/{folder}/**/part-*", recursive=True))

    before = files()
    assert registry.queries()[query](spark, SF).limit(1).count() <= 1
    written = files() - before
    assert written and all(f.endswith(".gz") for f in written)


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if os.path.basename(f).startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, conf = shuffled(), spark.conf.get(key)
    kept = stored(spark.range(0, 10_000, 1, 4).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count(), "test-shuffles")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(key) == conf
    assert {r.k: r["count"] for r in kept.collect()} == {k: len(range(k, 10_000, 7)) for k in range(7)}
