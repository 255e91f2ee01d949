import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.operators import columns
from rollbook.session import scratch_dir
from rollbook.sources import landed, snapshots
from rollbook.sources import rules as rule_source
from rollbook.sources.tables import KeyedTable
from tests.conftest import as_set


def write_files(folder, *bodies):
    folder.mkdir(parents=True, exist_ok=True)
    for i, body in enumerate(bodies):
        text = body if isinstance(body, str) else json.dumps(body, ensure_ascii=False, indent=1)
        (folder / f"f{i}.json").write_text(text, encoding="utf-8")
    return str(folder)


def test_registry_files(spark, tmp_path):
    record = {"Brn": "1", "Chinese_Company_Name": "大新", "Re-domiciliation_Date": "2024-01-01", "Extra": 1}
    path = write_files(tmp_path / "in", [record, {"Brn": "2"}], [], {"Brn": "lone"}, "{bad", '"text"', "null")
    got = columns.rename_fields(landed.registry_records(landed.read_bodies(spark, path)))
    assert as_set(got.select("cr_no", "name_zh", "re_domiciliation_date")) == [("1", "大新", "2024-01-01"), ("2", None, None)]


ITEM = {"code": " 01 ", "name_zh": "農業", "name_en": "", "level": 2, "parent_code": " A "}


@pytest.mark.parametrize("body", [[ITEM], {"data": [ITEM]}, {"records": [ITEM]}, {"data": [ITEM], "records": []}])
def test_code_file_layouts(spark, tmp_path, body):
    bodies = landed.read_bodies(spark, write_files(tmp_path / "codes", body))
    assert as_set(landed.classification_codes(bodies)) == [("01", 2, "農業", "", "A")]


def test_code_items(spark, tmp_path):
    items = [
        {"sic_code": "02", "name_c": "漁業", "parent_code": ""}, {"code": "", "sic_code": "03", "name_e": "Fish", "level": "3"},
        {"code": "04"}, {"name_en": "no code"}, {"code": "05", "name_en": "bad level", "level": "two"},
    ]
    bodies = landed.read_bodies(spark, write_files(tmp_path / "codes", items))
    assert as_set(landed.classification_codes(bodies)) == [("02", 1, "漁業", "", None), ("03", 3, "", "Fish", None)]
    assert as_set(landed.rejected_codes(bodies).select("code", "level_text")) == [("05", "two")]


def test_keyword_file(spark, tmp_path):
    path = write_files(tmp_path / "kw", {"K": ["銀行", "Bank"], "A": ["農業"]})
    rules = rule_source.keyword_rules(rule_source.json_document(spark, path))
    want = [("A", 1, 0, "農業"), ("K", 0, 0, "銀行"), ("K", 0, 1, "Bank")]
    assert as_set(rules) == want
    saved = rule_source.save_keywords(rules, str(tmp_path / "saved"))
    assert as_set(rule_source.load_saved_keywords(spark, saved)) == want


def test_built_in_sections_and_default_keywords(spark):
    table = rule_source.section_table(spark)
    assert table.count() == 19 and table.where("level <> 1 OR parent_code IS NOT NULL").isEmpty()
    keywords = rule_source.default_keywords(spark)
    assert keywords.select("section").distinct().count() == 19
    assert {("K", "Insurance"), ("A", "林業"), ("A", "漁業")} & set(as_set(keywords.select("section", "keyword")))
    assert keywords.where("keyword = '' OR keyword = 'and'").isEmpty()


def test_too_many_rules_are_not_collected(spark):
    assert rule_source.collect_rules(spark.range(11), 10) is None
    assert len(rule_source.collect_rules(spark.range(10), 10)) == 10


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('raw_address,expected_district\n"九龍, 旺角",油尖旺區\n  新界  ,\n', encoding="utf-8")
    assert as_set(snapshots.read_address_csv(spark, str(path))) == [("  新界  ", None), ("九龍, 旺角", "油尖旺區")]
    df = spark.createDataFrame([('say "hi", now', "x")], schemas.ADDRESS_SAMPLES)
    out = snapshots.export_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(out)
    assert as_set(back) == as_set(df) and back.columns == df.columns


def test_snapshot_resume(spark, tmp_path):
    one, two = spark.range(1), spark.range(2)
    path = snapshots.write_snapshot(one, str(tmp_path), "20240101")
    assert os.path.basename(path) == "snapshot_date=20240101"
    snapshots.write_snapshot(two, str(tmp_path), "20240101")
    assert spark.read.parquet(path).count() == 1
    snapshots.write_snapshot(two, str(tmp_path), "20240101", resume=False)
    assert spark.read.parquet(path).count() == 2
    os.remove(f"{path}/_SUCCESS")  # a write that never finished is done again
    snapshots.write_snapshot(one, str(tmp_path), "20240101")
    assert spark.read.parquet(path).count() == 1


def test_snapshot_of_a_schema(spark, tmp_path):
    spark.createDataFrame([("1", "x")], "cr_no string, other string").write.parquet(str(tmp_path / "s"))
    df = snapshots.read_snapshot(spark, str(tmp_path / "s"), schemas.SNAPSHOT)
    assert df.select("cr_no", "name_zh").first()[:] == ("1", None)
    assert snapshots.keep_known(spark.read.parquet(str(tmp_path / "s"))).columns == ["cr_no"]


def test_unfinished_version_does_not_count(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), schemas.columns("k n:int"))
    assert table.latest() is None and table.read().isEmpty()
    table.write(spark.createDataFrame([("a", 1)], "k string, n int"))
    table.write(table.read().withColumn("n", F.lit(2)))
    assert table.latest() == 1 and as_set(table.read()) == [("a", 2)]
    os.remove(f"{tmp_path}/t/v=1/_SUCCESS")
    assert table.latest() == 0 and as_set(table.read()) == [("a", 1)]
    table.write(spark.createDataFrame([("b", 3)], "k string, n int"))
    assert table.latest() == 2 and as_set(table.read()) == [("b", 3)]


def test_column_added_later(spark, tmp_path):
    KeyedTable(spark, str(tmp_path / "t"), schemas.columns("k")).write(spark.createDataFrame([("a",)], "k string"))
    assert as_set(KeyedTable(spark, str(tmp_path / "t"), schemas.columns("k tag")).read()) == [("a", None)]


class _Session:
    """Stands in for a session whose start-up settings cannot be changed any more."""

    def __init__(self, **settings):
        self.conf = settings


def test_scratch_follows_the_checkpoint_setting():
    shared = _Session(**{"spark.checkpoint.dir": "hdfs://shared/ckpt/"})
    assert scratch_dir(shared, "x").startswith("hdfs://shared/ckpt/rollbook/x-")
    assert os.path.isdir(scratch_dir(_Session(**{"spark.master": "local[8]"}), "x"))


def test_stamp_is_one_value(spark):
    now = dt.datetime(2024, 1, 1)
    assert as_set(columns.stamp(spark.range(3), now).select("fetched_at").distinct()) == [(now,)]


def test_tables_refuse_a_second_writer_and_keep_versions(spark, tmp_path, monkeypatch):
    from rollbook.sources.paths import folder_names
    from rollbook.sources.tables import KeyedTable

    df = spark.range(3).selectExpr("cast(id AS string) AS k")
    table = KeyedTable(spark, str(tmp_path / "t"), df.schema, keep_versions=2)
    for n in range(4):
        table.write(df.limit(n))
    assert sorted(folder_names(spark, str(tmp_path / "t"))) == ["v=2", "v=3"] and table.read().count() == 3
    other = KeyedTable(spark, str(tmp_path / "t"), df.schema)
    # As if it had looked before the last write: both chose number 3, the claim is the other's.
    monkeypatch.setattr(other, "_numbers", lambda: [2])
    with monkeypatch.context() as looked, pytest.raises(RuntimeError, match="another writer"):
        looked.setattr("rollbook.sources.tables.file_names", lambda *_: [])
        other.write(df)
    assert table.read().count() == 3
    (tmp_path / "t" / "v=7").mkdir()  # begun, not finished
    table.write(df.limit(1))
    assert table.latest() == 8 and table.read().count() == 1


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    from rollbook.session import scratch_dir

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        conf = Conf(**{"spark.master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")
    Session.conf = Conf(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///c/"})
    assert scratch_dir(Session(), "x").startswith("hdfs:///c/rollbook/x-")
