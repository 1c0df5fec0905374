"""The reports on the source tables, over the derived sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumbung.plans import verification as r
from lumbung.plans.fixed_values import PLATFORMS
from workload.derived_sources import derived_sources
from workload.registry import query
from workload.star_oracles import statement


def _union(columns: str, **tables: str) -> str:
    """``tables``: source code -> "table: expression, expression" in the order of ``columns``."""
    names = columns.split()
    parts = []
    for code, text in tables.items():
        table, expressions = text.split(": ")
        shown = ", ".join(f"{e} AS {n}" for e, n in zip(expressions.split(", "), names))
        parts.append(f"SELECT '{PLATFORMS[code][1]}' AS nama_platform, {shown} FROM {code}_{table}")
    return "(" + " UNION ALL ".join(parts) + ")"


USERS = _union(
    "province day",
    zb="member: domisili, waktu_registrasi",
    rc="siswa: domisili_provinsi, tanggal_registrasi",
    kj="pengguna: asal_provinsi, created_date",
    pn="siswa_pintarnusa: provinsi, tanggal_gabung",
)
EXAMS = _union(
    "raw score day",
    zb="nilai_tryout: skor::DOUBLE, skor::DOUBLE / 10, tanggal_submit",
    rc="hasil_kuis: nilai::DOUBLE, nilai::DOUBLE, tanggal_kuis",
    kj="skor_evaluasi: score_percent, score_percent, tanggal_evaluasi",
    pn="hasil_assessment: nilai_akhir, nilai_akhir, tanggal_assessment",
)
PAYMENTS = _union(
    "package amount free",
    zb="order_langganan: paket, total_harga, 'Gratis'",
    rc="transaksi_paket: nama_paket, harga, 'Gratis'",
    kj="invoice_pembayaran: nama_produk_paket, amount, 'Free'",
    pn="tagihan_program: nama_paket, nominal, 'Gratis'",
)
REVIEWS = _union(
    "rating device",
    zb="feedback_program: skor_rating, device",
    rc="ulasan_kelas: rating, device",
    kj="review_kelas: star_rating, device",
    pn="ulasan_program: rating, device",
)
SESSIONS = _union(
    "minutes person",
    rc="log_video: durasi_menit, id_siswa",
    pn="sesi_belajar: durasi_menit, id_siswa",
)


def _pct(test: str, name: str) -> str:
    return f"round(sum(CASE WHEN {test} THEN 1 ELSE 0 END) * 100.0 / count(*), 4) AS {name}"


def _counts(column: str, table: str) -> str:
    return f"SELECT nama_platform, {column}, count(*) AS n_rows FROM {table} GROUP BY ALL"


def _bins(column: str, table: str, bins: int) -> str:
    return (
        f"SELECT nama_platform, least(floor(({column} - low) / (high - low) * {bins}), {bins - 1})"
        f"::INTEGER AS bin, count(*) AS n_rows FROM (SELECT *, min({column}) OVER w AS low,"
        f" max({column}) OVER w AS high FROM {table} WINDOW w AS (PARTITION BY nama_platform))"
        " GROUP BY ALL"
    )


HOME = _pct("regexp_matches(province, 'Jawa|Jakarta|Banten|Yogyakarta')", "{}")
PEAK = _pct("month(day) IN (4, 5, 6)", "peak_pct")
PAID = _pct("package <> free", "paid_package_pct")

REPORTS: dict[str, tuple[Callable, str]] = {
    "verify_top_provinces": (
        r.top_provinces,
        "SELECT *, row_number() OVER (PARTITION BY nama_platform ORDER BY n_rows DESC,"
        f" province NULLS FIRST)::INTEGER AS rank FROM ({_counts('province', USERS)})"
        " QUALIFY rank <= 10",
    ),
    "verify_home_island_share": (
        r.home_island_share,
        f"SELECT nama_platform, count(*) AS n_rows, {HOME.format('share_pct')} FROM {USERS}"
        " GROUP BY ALL",
    ),
    "verify_registration_timeline": (
        r.registration_timeline,
        _counts("month", f"(SELECT nama_platform, strftime(day, '%Y-%m') AS month FROM {USERS})"),
    ),
    "verify_registration_range": (
        r.registration_range,
        f"SELECT nama_platform, min(day) AS low, max(day) AS high FROM {USERS} GROUP BY ALL",
    ),
    "verify_score_report": (
        r.score_report,
        "SELECT nama_platform, count(*) AS n_rows, round(sum(score) / count(*), 4) AS mean,"
        f" round(median(score), 4) AS median FROM {EXAMS} GROUP BY ALL",
    ),
    "verify_score_histogram": (r.score_histogram, _bins("raw", EXAMS, 30)),
    "verify_exam_months": (
        r.exam_months,
        "SELECT p.nama_platform, m.month, coalesce(c.n_rows, 0) AS n_rows, p.peak_pct FROM"
        f" (SELECT nama_platform, {PEAK} FROM {EXAMS} GROUP BY ALL) p"
        " CROSS JOIN (SELECT range::INTEGER AS month FROM range(1, 13)) m LEFT JOIN ("
        + _counts("month", f"(SELECT nama_platform, month(day) AS month FROM {EXAMS})")
        + ") c ON p.nama_platform = c.nama_platform AND m.month = c.month",
    ),
    "verify_rating_counts": (r.rating_counts, _counts("rating", REVIEWS)),
    "verify_package_counts": (r.package_counts, _counts("package", PAYMENTS)),
    "verify_paid_conversion": (
        r.paid_conversion,
        f"SELECT nama_platform, count(*) AS n_rows, {PAID}, {_pct('amount > 0', 'paid_amount_pct')}"
        f" FROM {PAYMENTS} GROUP BY ALL",
    ),
    "verify_sessions": (
        r.session_report,
        "SELECT nama_platform, count(*) AS n_rows, count(DISTINCT person) AS n_users,"
        " round(avg(minutes), 4) AS mean_duration, avg(minutes) BETWEEN 5 AND 20 AS in_target,"
        f" round(count(*) / count(DISTINCT person), 4) AS events_per_user FROM {SESSIONS}"
        " GROUP BY ALL",
    ),
    "verify_session_histogram": (r.session_histogram, _bins("minutes", SESSIONS, 20)),
    "verify_devices": (
        r.device_rule,
        "SELECT nama_platform, device AS value, count(*) AS n_rows, 'not allowed' AS problem"
        f" FROM {REVIEWS} WHERE device NOT IN ('ios', 'web', 'android') GROUP BY ALL"
        " UNION ALL SELECT p.nama_platform, d.device, 0, 'absent'"
        f" FROM (SELECT DISTINCT nama_platform FROM {REVIEWS}) p"
        " CROSS JOIN (SELECT unnest(['ios', 'web', 'android']) AS device) d"
        f" WHERE NOT EXISTS (SELECT 1 FROM {REVIEWS} x"
        " WHERE x.nama_platform = p.nama_platform AND x.device = d.device)",
    ),
    "verify_payments_per_user": (
        r.payments_per_user_rule,
        "SELECT *, n_payments >= n_users AS holds FROM"
        f" (SELECT nama_platform, count(*) AS n_payments FROM {PAYMENTS} GROUP BY ALL) JOIN"
        f" (SELECT nama_platform, count(*) AS n_users FROM {USERS} GROUP BY ALL)"
        " USING (nama_platform)",
    ),
    "verify_science_scores": (
        r.science_scores,
        "SELECT subject_name, count(*) AS n_rows, round(sum(score_percent) / count(*), 4) AS mean"
        " FROM kj_skor_evaluasi JOIN kj_produk_kelas USING (produk_id)"
        " WHERE subject_name IN ('Mathematics', 'Physics', 'Chemistry') GROUP BY ALL",
    ),
    "verify_scorecard": (
        r.platform_scorecard,
        f"SELECT * FROM (SELECT nama_platform, count(*) AS n_users, {HOME.format('home_island_pct')}"
        f" FROM {USERS} GROUP BY ALL) JOIN (SELECT nama_platform, round(sum(score) / count(*), 4)"
        f" AS mean_score, {PEAK} FROM {EXAMS} GROUP BY ALL) USING (nama_platform)"
        " JOIN (SELECT nama_platform, round(avg(rating), 4) AS mean_rating"
        f" FROM {REVIEWS} GROUP BY ALL) USING (nama_platform)"
        f" JOIN (SELECT nama_platform, {PAID} FROM {PAYMENTS} GROUP BY ALL) USING (nama_platform)",
    ),
}


def _register(name: str, report: Callable, sql: str) -> None:
    @query(name, statement(sql))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(derived_sources(spark, sf_dir))


for _name, (_report, _sql) in REPORTS.items():
    _register(_name, _report, _sql)
