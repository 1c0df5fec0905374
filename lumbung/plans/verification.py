"""Reports on the source tables as they are, one row set for all platforms (Q1-Q18).

They look at the data before any standardisation or gate: what provinces,
scores, ratings, packages, devices and dates each platform delivers.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.functions.exact import exact_sum, rounded_quotient
from lumbung.operators.checks import domain_rule, row_count_rule
from lumbung.operators.conform import union_all
from lumbung.operators.profile import (
    activity_stats,
    histogram,
    month_profile,
    pattern_share,
    score_stats,
    scorecard,
    share,
    subject_scores,
    timeline,
    top_values,
    value_counts,
    value_range,
)
from lumbung.plans.catalog import COURSE_ID, USER_ID
from lumbung.plans.fixed_values import (
    FREE_PACKAGES,
    FULL_MARKS,
    HOME_ISLAND_PATTERN,
    PLATFORMS,
    REVIEW_DEVICES,
    SCIENCE_SUBJECTS,
    SESSION_MINUTES,
)

Sources = Mapping[str, Mapping[str, DataFrame]]

PLATFORM = "nama_platform"


@dataclass(frozen=True)
class Observed:
    """One table of a source and the columns a report looks at."""

    table: str
    columns: Mapping[str, str]


# ---------------------------------------------------------------- fixed values
# Tables and columns of the sources.
USERS = {
    "zb": Observed("member", {"province": "domisili", "day": "waktu_registrasi"}),
    "rc": Observed("siswa", {"province": "domisili_provinsi", "day": "tanggal_registrasi"}),
    "kj": Observed("pengguna", {"province": "asal_provinsi", "day": "created_date"}),
    "pn": Observed("siswa_pintarnusa", {"province": "provinsi", "day": "tanggal_gabung"}),
}
EXAMS = {
    "zb": Observed("nilai_tryout", {"raw": "skor", "day": "tanggal_submit"}),
    "rc": Observed("hasil_kuis", {"raw": "nilai", "day": "tanggal_kuis"}),
    "kj": Observed("skor_evaluasi", {"raw": "score_percent", "day": "tanggal_evaluasi"}),
    "pn": Observed("hasil_assessment", {"raw": "nilai_akhir", "day": "tanggal_assessment"}),
}
PAYMENTS = {
    "zb": Observed("order_langganan", {"package": "paket", "amount": "total_harga"}),
    "rc": Observed("transaksi_paket", {"package": "nama_paket", "amount": "harga"}),
    "kj": Observed("invoice_pembayaran", {"package": "nama_produk_paket", "amount": "amount"}),
    "pn": Observed("tagihan_program", {"package": "nama_paket", "amount": "nominal"}),
}
REVIEWS = {
    "zb": Observed("feedback_program", {"rating": "skor_rating", "device": "device"}),
    "rc": Observed("ulasan_kelas", {"rating": "rating", "device": "device"}),
    "kj": Observed("review_kelas", {"rating": "star_rating", "device": "device"}),
    "pn": Observed("ulasan_program", {"rating": "rating", "device": "device"}),
}
SESSIONS = {
    "rc": Observed("log_video", {"minutes": "durasi_menit", "user": USER_ID["rc"]}),
    "pn": Observed("sesi_belajar", {"minutes": "durasi_menit", "user": USER_ID["pn"]}),
}
# ----------------------------------------------------------------------------


def observations(sources: Sources, observed: Mapping[str, Observed], **types: str) -> DataFrame:
    """The observed columns of all platforms; ``types`` gives a column its common type."""

    def column(name: str, source: str) -> Column:
        value = F.col(source)
        return (value.try_cast(types[name]) if name in types else value).alias(name)

    return union_all(
        sources[code][item.table].select(
            F.lit(code).alias("code"),
            F.lit(PLATFORMS[code][1]).alias(PLATFORM),
            *(column(name, source) for name, source in item.columns.items()),
        )
        for code, item in observed.items()
    )


def _per_code(values: Mapping[str, object], otherwise: object = None) -> Column:
    result = F.lit(otherwise)
    for code, value in values.items():
        result = F.when(F.col("code") == code, F.lit(value)).otherwise(result)
    return result


def top_provinces(sources: Sources, k: int = 10) -> DataFrame:
    return top_values(observations(sources, USERS), "province", k, [PLATFORM])


def home_island_share(sources: Sources) -> DataFrame:
    return pattern_share(observations(sources, USERS), "province", HOME_ISLAND_PATTERN, [PLATFORM])


def registration_timeline(sources: Sources) -> DataFrame:
    return timeline(observations(sources, USERS), "day", [PLATFORM])


def registration_range(sources: Sources) -> DataFrame:
    return value_range(observations(sources, USERS), "day", [PLATFORM])


def score_report(sources: Sources) -> DataFrame:
    """Scores of all platforms on the scale to 100: summed as delivered, and divided once."""
    exams = observations(sources, EXAMS, raw="double")
    unit = _per_code({code: full / 100 for code, full in FULL_MARKS.items()}, 1.0)
    return score_stats(exams, "raw", [PLATFORM], unit)


def score_histogram(sources: Sources, bins: int = 30) -> DataFrame:
    return histogram(observations(sources, EXAMS, raw="double"), "raw", bins, [PLATFORM])


def exam_months(sources: Sources) -> DataFrame:
    return month_profile(observations(sources, EXAMS, raw="double"), "day", [PLATFORM])


def rating_counts(sources: Sources) -> DataFrame:
    return value_counts(observations(sources, REVIEWS), "rating", [PLATFORM])


def _rating_means(sources: Sources) -> DataFrame:
    reviews = observations(sources, REVIEWS)
    total = exact_sum(F.col("rating"), reviews.schema["rating"].dataType)
    return reviews.groupBy(PLATFORM).agg(rounded_quotient(total, F.count("rating")).alias("mean_rating"))


def package_counts(sources: Sources) -> DataFrame:
    return value_counts(observations(sources, PAYMENTS), "package", [PLATFORM])


def paid_conversion(sources: Sources) -> DataFrame:
    """The share of payments not for the platform's free package, and above zero."""
    payments = observations(sources, PAYMENTS)
    free = F.coalesce(F.col("package") == _per_code(FREE_PACKAGES), F.lit(False))
    return payments.groupBy(PLATFORM).agg(
        F.count(F.lit(1)).alias("n_rows"),
        share(~free).alias("paid_package_pct"),
        share(F.col("amount") > 0).alias("paid_amount_pct"),
    )


def session_report(sources: Sources) -> DataFrame:
    sessions = observations(sources, SESSIONS)
    return activity_stats(sessions, "minutes", "user", [PLATFORM], *SESSION_MINUTES)


def session_histogram(sources: Sources, bins: int = 20) -> DataFrame:
    return histogram(observations(sources, SESSIONS), "minutes", bins, [PLATFORM])


def device_rule(sources: Sources) -> DataFrame:
    return domain_rule(observations(sources, REVIEWS), "device", REVIEW_DEVICES, [PLATFORM])


def payments_per_user_rule(sources: Sources) -> DataFrame:
    users, payments = observations(sources, USERS), observations(sources, PAYMENTS)
    return row_count_rule(payments, users, PLATFORM, ("n_payments", "n_users"))


def science_scores(sources: Sources) -> DataFrame:
    """Scores of the document source by science subject."""
    exams = sources["kj"]["skor_evaluasi"].withColumn(
        "score", F.col("score_percent").try_cast("double")
    )
    key = COURSE_ID["kj"]
    return subject_scores(
        exams, sources["kj"]["produk_kelas"], (key, key), "subject_name", SCIENCE_SUBJECTS, "score"
    )


def platform_scorecard(sources: Sources) -> DataFrame:
    """Q14: one row per platform out of the reports above."""
    members = observations(sources, USERS).groupBy(PLATFORM).agg(F.count(F.lit(1)).alias("n_users"))
    peaks = exam_months(sources).where("month = 1").select(PLATFORM, "peak_pct")
    return scorecard(
        [
            members,
            score_report(sources).select(PLATFORM, F.col("mean").alias("mean_score")),
            _rating_means(sources),
            paid_conversion(sources).select(PLATFORM, "paid_package_pct"),
            peaks,
            home_island_share(sources).select(PLATFORM, F.col("share_pct").alias("home_island_pct")),
        ],
        PLATFORM,
    )
