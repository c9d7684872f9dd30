"""The parts in which a query writes its files follow the table."""

import glob

from streamcurate.functions.storage import shared_dir
from streamcurate.plans import queries_records as q


def test_parts_follow_the_scan(spark, tmp_path):
    rows = [(i, f'a "{i}"\nb', "en", "x") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.repartition(9).write.parquet(str(tmp_path / "documents.parquet"))
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    old = set(glob.glob(f"{shared_dir(spark)}/csv-text-*".removeprefix("file:")))
    try:
        spark.conf.set(name, str(1 << 27))  # a task for each file
        found = q.i1_quoted(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set(name, before)
    made = set(glob.glob(f"{shared_dir(spark)}/csv-text-*".removeprefix("file:"))) - old
    assert sorted(r.doc_id for r in found) == list(range(90))
    assert [len(glob.glob(f"{m}/part-*")) for m in made] == [9]
