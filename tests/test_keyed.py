import pytest

from rollbook.operators import columns, keyed
from rollbook import schemas
from tests.conftest import as_set

SCHEMA = "cr_no string, name string, n int"


@pytest.fixture
def base(rows):
    return rows([("1", "a", 1), ("2", "b", 2), ("3", None, 3)], SCHEMA)


@pytest.fixture
def updates(rows):
    return rows([("2", None, 20), ("3", "c", None), ("4", "d", 4), ("4", "e", 5), (None, "x", 9)], SCHEMA)


@pytest.mark.parametrize("form", ["delta", "outer"])
def test_upsert_overwrites_with_nulls_and_takes_the_latest(base, updates, form):
    got = keyed.upsert(base, updates, "cr_no", order_by=["n"], form=form)
    assert got.columns == base.columns
    assert as_set(got) == [("1", "a", 1), ("2", None, 20), ("3", "c", None), ("4", "e", 5)]


@pytest.mark.parametrize("form", ["delta", "outer"])
def test_upsert_of_some_columns(base, updates, form):
    got = keyed.upsert(base, updates, "cr_no", ["n"], order_by=["n"], form=form)
    assert as_set(got) == [("1", "a", 1), ("2", "b", 20), ("3", None, None), ("4", "e", 5)]


@pytest.mark.parametrize("form", ["delta", "outer"])
def test_upsert_without_a_column(base, updates, form):
    got = keyed.upsert(base, updates.select("cr_no", "n"), "cr_no", order_by=["n"], form=form)
    assert as_set(got) == [("1", "a", 1), ("2", "b", 20), ("3", None, None), ("4", None, 5)]


@pytest.mark.parametrize("form", ["delta", "outer"])
def test_upsert_twice_is_upsert_once(base, updates, form):
    once = keyed.upsert(base, updates, "cr_no", order_by=["n"], form=form)
    assert as_set(keyed.upsert(once, updates, "cr_no", order_by=["n"], form=form)) == as_set(once)


def test_upsert_of_an_unknown_form(base, updates):
    with pytest.raises(ValueError):
        keyed.upsert(base, updates, "cr_no", form="merge")


def test_order_column_outside_the_table(base, rows):
    updates = rows([("1", "late", 1, 2), ("1", "early", 9, 1)], SCHEMA + ", ver int")
    assert as_set(keyed.upsert(base, updates, "cr_no", order_by=["ver"]))[0] == ("1", "late", 1)


def test_update_ignores_unknown_keys(base, updates):
    got = keyed.update_by_key(base, updates, "cr_no", ["n"])
    assert as_set(got) == [("1", "a", 1), ("2", "b", 20), ("3", None, None)]


def test_manual_correction(base, rows):
    got = keyed.update_by_key(base, rows([("3", "K")], "cr_no string, name string"), "cr_no")
    assert ("3", "K", 3) in as_set(got)


def test_insert_ignore_is_idempotent(base, updates):
    once = keyed.insert_ignore(base, updates, "cr_no")
    assert [r[0] for r in as_set(once)] == ["1", "2", "3", "4"]
    assert ("2", "b", 2) in as_set(once)
    assert as_set(keyed.insert_ignore(once, updates, "cr_no")) == as_set(once)


def test_first_per_key_keeps_all_rows_without_key(rows):
    df = rows([("1", 2, "b"), ("1", 1, "a"), ("", 1, "x"), ("", 2, "y"), (None, 3, "z")], "cr_no string, ord int, v string")
    got = keyed.first_per_key(df, "cr_no", ["ord"])
    assert sorted(r["v"] for r in got.collect()) == ["a", "x", "y", "z"]


FOUR = "cr_no string, name_zh string, name_en string, address_raw string"


def test_delta(rows):
    old = rows([("1", "a", "b", "c"), ("2", None, "b", "c"), ("3", "a", "b", "c")], FOUR)
    new = rows([("1", "a", "b", "c"), ("2", None, "b", "c"), ("4", "a", "b", "c"), ("4", "a", "b", "c")], FOUR)
    assert [r[0] for r in as_set(keyed.snapshot_delta(new, old))] == ["2", "4", "4"]
    assert [r[0] for r in as_set(keyed.snapshot_delta(new, old, null_safe=True))] == ["4", "4"]
    assert keyed.snapshot_delta(new, new, null_safe=True).isEmpty()


def test_delta_on_common_columns(rows):
    old = rows([("1", "a")], "cr_no string, name_zh string")
    new = rows([("1", "a", "x"), ("2", "a", "x")], "cr_no string, name_zh string, address_raw string")
    assert as_set(keyed.snapshot_delta(new, old)) == [("2", "a", "x")]


def test_headers(rows):
    df = rows([("1", "a", None, "addr2", "v")], " CompanyNo string, address string, `Registered Office-X` string, RegisteredOfficeAddress string, keep string")
    got = columns.normalise_columns(df)
    assert got.columns[:4] == ["cr_no", "address_raw", "Registered Office-X", "keep"]
    assert set(schemas.REQUIRED_COLUMNS + schemas.EXTRA_COLUMNS) <= set(got.columns)
    assert got.first()["address_raw"] == "a"
    renamed = columns.rename_fields(rows([("x", 1)], "`Re-domiciliation_Date` string, `Other Field-A` int"))
    assert renamed.columns == ["re_domiciliation_date", "other_field_a"]
    verify = columns.rename_verify_fields(rows([("x", 1)], "Brn string, `Other Field-A` int"))
    assert verify.columns == ["cr_no", "other field-a"]


def test_conform_casts_pads_and_drops(rows):
    df = rows([("2024-01-01T10:00:00", "x", "7"), ("no time", "y", "z")], "queried_at string, brn string, junk string")
    got = columns.conform(df, schemas.SCAN_QUEUE)
    assert got.schema.names == ["brn", "status", "queried_at", "batch_id"]
    assert [(r["brn"], r["queried_at"] is None, r["status"]) for r in got.collect()] == [("x", False, None), ("y", True, None)]


def test_updates_older_than_the_row_are_left_out(rows):
    base = rows([("a", 5, "x"), ("b", None, "x"), ("c", 5, "x"), ("d", 5, "x")], "k string, t int, v string")
    new = rows([("a", 4, "y"), ("b", 1, "y"), ("c", 5, "y"), ("d", None, "y"), ("e", 1, "y"), ("a", 3, "z")], "k string, t int, v string")
    want = [("a", 5, "x"), ("b", 1, "y"), ("c", 5, "y"), ("d", None, "y")]
    for form in ("outer", "delta"):
        assert as_set(keyed.upsert(base, new, "k", order_by=["t"], form=form, newer_by="t")) == [*want, ("e", 1, "y")]
    assert as_set(keyed.update_by_key(base, new, "k", order_by=["t"], newer_by="t")) == want
