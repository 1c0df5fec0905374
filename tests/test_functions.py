import datetime as dt
import hashlib
import zlib
from decimal import Decimal

import pytest
from helpers import frame, one_column, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumbung.functions import (
    blank_to_unknown,
    collision_report,
    first_existing_column,
    global_id,
    key_collisions,
    pii_hash,
    prefixed_id,
    recode,
    rescale,
    safe_date,
    standardize,
    standardize_with_table,
    surrogate_key,
    threshold_label,
    whole_number,
)
from lumbung.plans import fixed_values as v


def strings(spark, *values):
    return frame(spark, "raw string", *((x,) for x in values))


CASES = ["web", "WEB", " web ", "fridge", "", None, "null"]


def test_device_lookup_is_normalised_and_never_null(spark):
    got = one_column(strings(spark, *CASES), v.DEVICE(F.col("raw")))
    unknown = "tidak diketahui"
    assert got == ["desktop", "desktop", "desktop", unknown, unknown, unknown, unknown]


def test_miss_policies(spark):
    entries = {"a": "A", "it's \\ odd": "quoted"}
    df = strings(spark, "a", " A ", "it's \\ odd", "b", None)
    raw = F.col("raw")
    assert one_column(df, standardize(raw, entries)) == ["A", None, "quoted", None, None]
    assert one_column(df, standardize(raw, entries, on_miss="source")) == [
        "A", " A ", "quoted", "b", None,
    ]
    assert one_column(df, standardize(raw, entries, on_miss="literal", default="?")) == [
        "A", "?", "quoted", "?", "?",
    ]
    assert one_column(df, standardize(raw, entries, normalize=True)) == [
        "A", "A", "quoted", None, None,
    ]
    with pytest.raises(ValueError):
        standardize(raw, entries, on_miss="guess")


def test_method_categories_are_looked_up_by_standard_names(spark):
    df = strings(spark, "e-wallet", "transfer", "kartu", "minimarket", "gratis")
    assert one_column(df, v.METHOD_CATEGORY(F.col("raw"))) == [
        "pembayaran digital", "lainnya", "lainnya", "retail", "gratis",
    ]


def test_table_lookup_equals_literal_lookup(spark):
    df = strings(spark, "web", " IOS", "x", None)
    table = frame(spark, "k string, label string", *v.DEVICES.items())
    got = standardize_with_table(
        df, "raw", table, key="k", label="label", into="out",
        normalize=True, on_miss="literal", default="tidak diketahui",
    )
    assert rows_of(got) == rows_of(df.select("raw", v.DEVICE(F.col("raw")).alias("out")))


def test_blank_to_unknown_keeps_other_text_untrimmed(spark):
    df = strings(spark, "Bali", None, "", "  ", "nan", " NaN ", " Jawa ")
    unknown = "Tidak Diketahui"
    assert one_column(df, blank_to_unknown("raw")) == ["Bali", *[unknown] * 5, " Jawa "]
    assert set(one_column(df, blank_to_unknown(None))) == {unknown}


def test_first_existing_column(spark):
    df = frame(spark, "b int, c int", (1, 2))
    assert first_existing_column(df, ["a", "c", "b"]) == "c"
    assert first_existing_column(df, ["x"]) is None
    with pytest.raises(ValueError, match="none of the columns"):
        first_existing_column(df, ["x", "y"], required=True)


def test_prefixed_id_of_null_is_null(spark):
    df = frame(spark, "id int", (7,), (None,))
    assert one_column(df, prefixed_id("ZB-AK-", "id")) == ["ZB-AK-7", None]


def test_malformed_dates_become_null(spark):
    df = strings(spark, "2024-02-29", "2023-02-29", "x", "", None, "2024-01-05 10:00:00")
    assert one_column(df, safe_date("raw")) == [
        dt.date(2024, 2, 29), None, None, None, None, dt.date(2024, 1, 5),
    ]


def test_rescale_and_overflow(spark):
    df = frame(spark, "x int", (717,), (1,), (10**9,), (None,))
    assert one_column(df, rescale("x", "decimal(5,2)", divided_by=10)) == [
        Decimal("71.70"), Decimal("0.10"), None, None,
    ]
    ratings = frame(spark, "x int", (1,), (2,), (9,), (10,))
    assert one_column(ratings, rescale("x", "decimal(3,1)", divided_by=2)) == [
        Decimal("0.5"), Decimal("1.0"), Decimal("4.5"), Decimal("5.0"),
    ]


def test_threshold_recode_truncate(spark):
    df = frame(spark, "x double", (70.0,), (69.9,), (None,))
    assert one_column(df, threshold_label(F.col("x"), 70)) == ["lulus", "tidak_lulus", "tidak_lulus"]
    minutes = frame(spark, "x decimal(10,2)", (Decimal("25.99"),), (Decimal("0.00"),))
    assert one_column(minutes, whole_number(F.col("x"))) == [25, 0]
    levels = strings(spark, "Junior High", "Other", None)
    assert one_column(levels, recode(F.col("raw"), v.SCHOOL_LEVEL_NAMES)) == ["SMP", "Other", None]


def test_identity_ignores_case_only(spark):
    df = strings(spark, "A@x.id", "a@X.ID", " a@x.id", None)
    hashes = one_column(df, pii_hash("raw"))
    assert hashes[0] == hashes[1] == hashlib.md5(b"a@x.id").hexdigest()
    assert hashes[2] != hashes[0] and hashes[3] is None
    ids = one_column(df, global_id("USR-", pii_hash("raw")))
    again = hashlib.md5(hashes[0].encode()).hexdigest().upper()
    assert ids[0] == f"USR-{again}" and ids[3] is None
    assert one_column(df, global_id("USR-", pii_hash("raw"), 8))[0] == f"USR-{again[:8]}"


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text(max_size=12), min_size=1, max_size=30))
def test_surrogate_keys(spark, texts):
    texts = [t.replace("\x00", "") for t in texts]
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = strings(spark, *texts)
    assert one_column(df, surrogate_key(F.col("raw"), "crc32")) == [zlib.crc32(t.encode()) for t in texts]
    assert one_column(df, surrogate_key(F.col("raw"))) == [
        int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in texts
    ]


def test_surrogate_key_of_a_date_is_that_of_its_text(spark):
    df = frame(spark, "d date", (dt.date(2024, 1, 5),), (None,))
    assert one_column(df, surrogate_key(F.col("d"), "crc32")) == [zlib.crc32(b"2024-01-05"), None]


def test_key_collisions(spark):
    df = frame(spark, "k int, name string", (1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "d"))
    assert rows_of(key_collisions(df, "k", ["name"])) == [(2, 2)]
    report = collision_report({"t": (df, "k", "name"), "none": (df.where("k = 1"), "k", F.upper("name"))})
    assert rows_of(report) == [("none", 1, 1, 0), ("t", 3, 2, 1)]
    assert rows_of(collision_report({"e": (df.where("false"), "k", "name")})) == [("e", 0, 0, 0)]


def test_values_at_the_edge_of_a_decimal(spark):
    texts = ["99.994", "99.995", "-99.994", "99.999", "100", "1e30", "-1e30", "nan", "x", None]
    df = frame(spark, "raw string", *[(t,) for t in texts])
    fits = [Decimal("99.99"), None, Decimal("-99.99"), None, None, None, None, None, None, None]
    assert one_column(df, rescale("raw", "decimal(4,2)")) == fits
    halves = frame(spark, "x double", (99.99,), (199.96,), (199.99,), (float("inf"),), (None,))
    assert one_column(halves, rescale("x", "decimal(4,2)", divided_by=2)) == [
        Decimal("50.00"), Decimal("99.98"), None, None, None,
    ]


def test_some_entries_of_every_dictionary():
    """Stated here once more, so that a wrong entry does not pass on both sides of a query."""
    stated = {
        "LEVELS": {"beginner": "dasar", "medium": "menengah", "hard": "lanjut", "mahir": "lanjut"},
        "SUBJECTS": {"Mathematics": "Matematika", "English (General)": "Bahasa Inggris", "History": "Sejarah"},
        "REGISTRATION_STATUS": {"completed": "selesai", "cancelled": "batal", "dropout": "tidak_aktif"},
        "PAYMENT_STATUS": {"lunas": "berhasil", "unpaid": "gagal", "menunggu": "pending"},
        "PAYMENT_METHODS": {"QRIS": "e-wallet", "virtual_account": "transfer", "kartu_kredit": "kartu"},
        "PACKAGES": {"Basic": "reguler", "Elite": "premium", "Free": "gratis"},
        "DEVICES": {"ipad": "tablet", "browser": "desktop", "iphone": "mobile", "": "tidak diketahui"},
        "PAYMENT_METHOD_CATEGORIES": {"OVO": "pembayaran digital", "alfamart": "retail", "free": "gratis"},
        "MONTH_NAMES": {1: "Januari", 8: "Agustus", 12: "Desember"},
        "SCHOOL_LEVEL_RANKS": {"SD": 1, "SMP": 2, "SMA": 3},
        "PASS_MARKS": {"zb": 70, "rc": 70, "pn": 75},
    }
    for name, entries in stated.items():
        dictionary = getattr(v, name)
        assert {key: dictionary[key] for key in entries} == entries, name
