"""What the staging and warehouse tables hold, stated in SQL.

Every statement is one WITH query over the given tables.  Only the named
subqueries that a result needs are put into its statement.
"""

from __future__ import annotations

import re

from lumbung.plans import fixed_values as v
from workload.derived_sources import derived_ctes

AS_OF = "2024-01-20"


def label(column: str, entries: dict, miss: str = "NULL", normalize: bool = False) -> str:
    value = f"lower(trim({column}))" if normalize else column
    cases = " ".join(f"WHEN '{k}' THEN '{x}'" for k, x in entries.items())
    return f"CASE {value} {cases} ELSE {miss} END"


def place(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL OR trim({column}) = '' OR lower(trim({column})) = 'nan'"
        f" THEN 'Tidak Diketahui' ELSE {column} END"
    )


def device(column: str) -> str:
    return label(column, v.DEVICES, "'tidak diketahui'", normalize=True)


def key(text: str) -> str:
    """The surrogate key: 60 bits of the md5 of a text."""
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def crc32(text: str) -> str:
    """The checksum of an ASCII text, bit by bit (it is no function of DuckDB)."""
    step = (
        "list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1"
        " THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b))"
    )
    octets = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return (
        f"xor(list_reduce({octets}, lambda crc, b: {step}, 4294967295::BIGINT),"
        " 4294967295)::BIGINT"
    )


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _user(code, table, id_, email, name, level, grade, province, registered) -> str:
    platform = v.PLATFORMS[code][1]
    return (
        f"SELECT '{platform}' AS nama_platform, {id_} AS id_pengguna_platform,"
        f" md5(lower({email})) AS email_hash, {email} AS email_asli, {name} AS nama_standar,"
        f" {level} AS jenjang_standar, {grade}::VARCHAR AS kelas_sekolah_standar,"
        f" {place(province)} AS provinsi_standar, {registered}::DATE AS tanggal_daftar"
        f" FROM {code}_{table}"
    )


def _course(code, table, id_, subject, level, difficulty, teacher) -> str:
    id_platform, platform, _ = v.PLATFORMS[code]
    standard = label(subject, v.SUBJECTS, subject)
    return (
        f"SELECT '{platform}' AS nama_platform, '{id_platform}' AS id_platform,"
        f" {id_} AS id_kelas_platform, {subject} AS mapel_sumber,"
        f" {standard} AS mata_pelajaran_standar, {level} AS jenjang_standar,"
        f" {difficulty} AS tingkat_kesulitan_standar, {teacher} AS pengajar FROM {code}_{table}"
    )


def _events(code, table, prefix, id_, user, course, day, measures: str) -> str:
    id_platform, platform, _ = v.PLATFORMS[code]
    course_column = f" {course} AS id_kelas_platform," if course else ""
    return (
        f"SELECT '{prefix}' || {id_} AS id, '{id_platform}' AS id_platform,"
        f" '{platform}' AS nama_platform, {user} AS id_pengguna_platform,{course_column}"
        f" {day}::DATE AS tanggal, {measures} FROM {code}_{table}"
    )


LEVEL_RC = label("tingkat_kesulitan", v.LEVELS, "tingkat_kesulitan", normalize=True)


def _state(column: str) -> str:
    return label(column, v.REGISTRATION_STATUS, "'aktif'", normalize=True) + " AS status"


def _passed(test: str) -> str:
    return f"CASE WHEN {test} THEN 'lulus' ELSE 'tidak_lulus' END AS status_lulus"


def _paid(package: str, method: str, total: str, state: str) -> str:
    return (
        f"{label(package, v.PACKAGES, package)} AS nama_paket_standar,"
        f" {label(method, v.PAYMENT_METHODS)} AS metode_bayar_standar,"
        f" {total}::DECIMAL(15,2) AS jumlah_bayar,"
        f" {label(state, v.PAYMENT_STATUS, chr(39) + 'Unknown' + chr(39))}"
        " AS status_bayar_standar"
    )


def _review(rating: str, comment: str, device_: str) -> str:
    return (
        f"({rating})::DECIMAL(3,1) AS rating_standar_5, {comment} AS komentar,"
        f" {device_} AS perangkat_standar"
    )


NO_DEVICE = "'tidak diketahui'"

RAW = {
    "raw_aktivitas": _union(
        _events(
            "zb", "riwayat_belajar", "ZB-AK-", "id_riwayat", "kode_member", "kode_program",
            "waktu_mulai",
            "round(lama_belajar_detik / 60, 2)::DECIMAL(10,2) AS durasi,"
            f" {device('device')} AS perangkat_standar",
        ),
        _events(
            "rc", "log_video", "RC-AK-", "id_log", "id_siswa", "id_kelas", "waktu_mulai",
            f"durasi_menit::DECIMAL(10,2), {device('device')}",
        ),
        _events(
            "kj", "akses_materi", "KJ-AK-", "akses_id", "user_id", "produk_id", "tanggal",
            f"(watch_time * 60)::DECIMAL(10,2), {device('platform_device')}",
        ),
        _events(
            "pn", "sesi_belajar", "PN-AK-", "id_sesi", "id_siswa", "id_program", "tanggal_sesi",
            f"durasi_menit::DECIMAL(10,2), {device('perangkat')}",
        ),
    ),
    "raw_latihan": _union(
        _events(
            "zb", "nilai_tryout", "ZB-HL-", "id_tryout", "kode_member", "kode_program",
            "tanggal_submit",
            f"(skor / 10)::DECIMAL(5,2) AS nilai_standar, {_passed('skor >= 700')}",
        ),
        _events(
            "rc", "hasil_kuis", "RC-HL-", "id_kuis", "id_siswa", "id_kelas", "tanggal_kuis",
            f"nilai::DECIMAL(5,2), {_passed('nilai >= 70')}",
        ),
        _events(
            "kj", "skor_evaluasi", "KJ-HL-", "evaluasi_id", "user_id", "produk_id",
            "tanggal_evaluasi",
            "score_percent::DECIMAL(5,2), replace(status_lulus, ' ', '_')",
        ),
        _events(
            "pn", "hasil_assessment", "PN-HL-", "id_assessment", "id_siswa", "id_program",
            "tanggal_assessment",
            f"nilai_akhir::DECIMAL(5,2), {_passed('nilai_akhir >= 75')}",
        ),
    ),
    "raw_transaksi": _union(
        _events(
            "zb", "order_langganan", "ZB-TR-", "id_order", "kode_member", None, "tanggal_order",
            _paid("paket", "channel_pembayaran", "total_harga", "status_order"),
        ),
        _events(
            "rc", "transaksi_paket", "RC-TR-", "id_transaksi", "id_siswa", None,
            "tanggal_transaksi",
            _paid("nama_paket", "metode_pembayaran", "harga", "status_transaksi"),
        ),
        _events(
            "kj", "invoice_pembayaran", "KJ-TR-", "invoice_id", "user_id", None,
            "tanggal_invoice",
            _paid("nama_produk_paket", "payment_type", "amount", "payment_status"),
        ),
        _events(
            "pn", "tagihan_program", "PN-TR-", "id_tagihan", "id_siswa", None, "tanggal_tagihan",
            _paid("nama_paket", "metode_bayar", "nominal", "status_tagihan"),
        ),
    ),
    "raw_ulasan": _union(
        _events(
            "zb", "feedback_program", "ZB-UL-", "id_feedback", "kode_member", "kode_program",
            "tanggal_feedback", _review("skor_rating / 2", "ulasan_text", device("device")),
        ),
        _events(
            "rc", "ulasan_kelas", "RC-UL-", "id_ulasan", "id_siswa", "id_kelas",
            "tanggal_ulasan", _review("rating", "komentar", device("device")),
        ),
        _events(
            "kj", "review_kelas", "KJ-UL-", "review_id", "user_id", "produk_id", "review_date",
            _review("star_rating", "review_text", NO_DEVICE),
        ),
        _events(
            "pn", "ulasan_program", "PN-UL-", "id_ulasan", "id_siswa", "id_program",
            "tanggal_ulasan", _review("rating", "isi_ulasan", NO_DEVICE),
        ),
    ),
    "raw_pendaftaran": _union(
        _events(
            "zb", "peserta_program", "ZB-PD-", "id_peserta", "kode_member", "kode_program",
            "tanggal_daftar", _state("status_peserta"),
        ),
        _events(
            "rc", "pendaftaran_kelas", "RC-PD-", "id_pendaftaran", "id_siswa", "id_kelas",
            "tanggal_daftar", _state("status"),
        ),
        _events(
            "kj", "pembelian_kelas", "KJ-PD-", "pembelian_id", "user_id", "produk_id",
            "tanggal_beli", _state("status_pembelian"),
        ),
        _events(
            "pn", "enrolmen_program", "PN-PD-", "id_enrol", "id_siswa", "id_program",
            "tanggal_enrol", _state("status_aktif"),
        ),
    ),
}


def _resolved(raw: str, course: bool) -> str:
    course_join = (
        " LEFT JOIN peta_kelas_lintas_platform k USING (nama_platform, id_kelas_platform)"
        if course
        else ""
    )
    course_column = ", k.id_kelas_global" if course else ""
    return (
        f"SELECT r.*, u.id_pengguna_global{course_column} FROM {raw} r"
        " LEFT JOIN peta_pengguna_lintas_platform u USING (nama_platform, id_pengguna_platform)"
        + course_join
    )


def _accepted(resolved: str, id_: str, day: str, columns: list[str], test: str) -> str:
    """The gated rows with one row, the least by all columns, per id."""
    course = "id_kelas_global" if "id_kelas_global" in columns else "id"
    shown = ", ".join(columns)
    order = ", ".join(f"{c.split(' AS ')[-1]} ASC NULLS FIRST" for c in columns)
    return (
        f"SELECT id AS {id_}, {shown.replace('tanggal', f'tanggal AS {day}')} FROM {resolved}"
        f" WHERE id IS NOT NULL AND id_pengguna_global IS NOT NULL AND {course} IS NOT NULL"
        f" AND {test} QUALIFY row_number() OVER (PARTITION BY id ORDER BY {order}) = 1"
    )


IN_TIME = f"tanggal <= DATE '{AS_OF}'"
WHO = ["id_platform", "id_pengguna_global", "id_kelas_global", "tanggal"]
TESTS = {
    "aktivitas": f"{IN_TIME} AND durasi >= 0",
    "latihan": f"{IN_TIME} AND nilai_standar BETWEEN 0 AND 100",
    "transaksi": f"{IN_TIME} AND jumlah_bayar >= 0",
    "ulasan": f"{IN_TIME} AND rating_standar_5 BETWEEN 1 AND 5",
    "pendaftaran": "TRUE",
}

CTES: dict[str, str] = {
    **derived_ctes(),
    "kamus_platform": " UNION ALL ".join(
        f"SELECT '{i}' AS id_platform, '{n}' AS nama_platform, '{k}' AS jenis_platform,"
        f" 'Platform {n}' AS keterangan"
        for i, n, k in v.PLATFORMS.values()
    ),
    "all_users": _union(
        _user("zb", "member", "kode_member", "alamat_email", "nama_lengkap", "level_sekolah",
              "tingkat_kelas", "domisili", "waktu_registrasi"),
        _user("rc", "siswa", "id_siswa", "email", "nama_siswa", "jenjang", "kelas",
              "domisili_provinsi", "tanggal_registrasi"),
        _user("kj", "pengguna", "user_id", "email_user", "nama", "jenjang_pendidikan", "kelas",
              "asal_provinsi", "created_date"),
        _user("pn", "siswa_pintarnusa", "id_siswa", "email", "nama_siswa", "tingkat_pendidikan",
              "kelas_tingkat", "provinsi", "tanggal_gabung"),
    ),
    "global_users": "SELECT DISTINCT email_hash, 'USR-' || upper(md5(email_hash))"
    " AS id_pengguna_global FROM all_users WHERE email_hash IS NOT NULL",
    "peta_pengguna_lintas_platform": "SELECT g.id_pengguna_global, u.*,"
    " 1::DECIMAL(3,2) AS confidence_score"
    " FROM all_users u JOIN global_users g ON u.email_hash = g.email_hash",
    "all_courses": _union(
        _course("zb", "program_belajar", "kode_program", "mapel", "target_jenjang",
                label("kategori_level", v.LEVELS), "mentor"),
        _course("rc", "kelas", "id_kelas", "mata_pelajaran", "jenjang", LEVEL_RC, "pengajar"),
        _course("kj", "produk_kelas", "produk_id", "subject_name",
                "CASE school_level WHEN 'Junior High' THEN 'SMP' WHEN 'Senior High' THEN 'SMA'"
                " ELSE school_level END", label("difficulty", v.LEVELS), "tutor_name"),
        _course("pn", "katalog_program", "id_program", "bidang_studi", "jenjang",
                label("level_kesulitan", v.LEVELS), "pengajar"),
    ),
    "named_courses": "SELECT *, concat_ws(' - ', mata_pelajaran_standar,"
    " concat_ws(' ', jenjang_standar, tingkat_kesulitan_standar)) AS nama_kelas_standar"
    " FROM all_courses",
    "peta_kelas_lintas_platform": "SELECT 'KLS-' || upper(md5(nama_kelas_standar))"
    " AS id_kelas_global, nama_platform, id_kelas_platform, id_platform, nama_kelas_standar,"
    " mata_pelajaran_standar, jenjang_standar, tingkat_kesulitan_standar, pengajar"
    " FROM named_courses",
    "kamus_mata_pelajaran": "SELECT DISTINCT mata_pelajaran_standar AS nama_mapel_standar,"
    " mapel_sumber AS nama_mapel_sumber, nama_platform FROM all_courses",
    **RAW,
    **{
        f"resolved_{kind}": _resolved(f"raw_{kind}", kind != "transaksi")
        for kind in TESTS
    },
    "olah_aktivitas_belajar": _accepted(
        "resolved_aktivitas", "id_aktivitas", "tanggal_aktivitas",
        [*WHO, "durasi AS durasi_belajar_menit", "perangkat_standar"], TESTS["aktivitas"],
    ),
    "olah_hasil_latihan": _accepted(
        "resolved_latihan", "id_hasil", "tanggal_latihan",
        [*WHO, "nilai_standar", "status_lulus"], TESTS["latihan"],
    ),
    "olah_transaksi": _accepted(
        "resolved_transaksi", "id_transaksi", "tanggal_transaksi",
        ["id_platform", "id_pengguna_global", "tanggal", "nama_paket_standar",
         "metode_bayar_standar", "jumlah_bayar", "status_bayar_standar"], TESTS["transaksi"],
    ),
    "olah_ulasan": _accepted(
        "resolved_ulasan", "id_ulasan", "tanggal_ulasan",
        [*WHO, "rating_standar_5", "komentar", "perangkat_standar"], TESTS["ulasan"],
    ),
    "olah_pendaftaran_program": _accepted(
        "resolved_pendaftaran", "id_pendaftaran", "tanggal_daftar",
        [*WHO, "status AS status_pendaftaran_standar"], TESTS["pendaftaran"],
    ),
    "days": "SELECT DISTINCT tanggal FROM ("
    " SELECT tanggal_aktivitas AS tanggal FROM olah_aktivitas_belajar"
    " UNION ALL SELECT tanggal_latihan FROM olah_hasil_latihan"
    " UNION ALL SELECT tanggal_transaksi FROM olah_transaksi"
    " UNION ALL SELECT tanggal_ulasan FROM olah_ulasan) WHERE tanggal IS NOT NULL",
    "dim_waktu": f"SELECT {key('tanggal::VARCHAR')} AS waktu_key, tanggal,"
    " month(tanggal)::INTEGER AS bulan,"
    f" {label('month(tanggal)::VARCHAR', v.MONTH_NAMES)} AS nama_bulan,"
    " 'Q' || quarter(tanggal) AS kuartal, year(tanggal)::INTEGER AS tahun FROM days",
    # with the days of enrolments
    "days_all": "SELECT tanggal FROM days UNION SELECT tanggal_daftar FROM olah_pendaftaran_program"
    " WHERE tanggal_daftar IS NOT NULL",
    "dim_waktu_all": f"SELECT {key('tanggal::VARCHAR')} AS waktu_key, tanggal,"
    " month(tanggal)::INTEGER AS bulan,"
    f" {label('month(tanggal)::VARCHAR', v.MONTH_NAMES)} AS nama_bulan,"
    " 'Q' || quarter(tanggal) AS kuartal, year(tanggal)::INTEGER AS tahun FROM days_all",
    "dim_platform": f"SELECT {key('id_platform')} AS platform_key, id_platform, nama_platform,"
    " jenis_platform FROM kamus_platform",
    "first_users": "SELECT * FROM peta_pengguna_lintas_platform"
    " QUALIFY row_number() OVER (PARTITION BY id_pengguna_global"
    " ORDER BY nama_platform, id_pengguna_platform) = 1",
    "dim_pengguna": f"SELECT {key('id_pengguna_global')} AS pengguna_key,"
    " id_pengguna_global AS id_pengguna_sumber, platform_key, nama_standar AS nama_pengguna,"
    " email_asli AS email, provinsi_standar AS provinsi, tanggal_daftar"
    " FROM first_users LEFT JOIN dim_platform USING (nama_platform)",
    "subjects": "SELECT DISTINCT nama_mapel_standar AS nama_mata_pelajaran"
    " FROM kamus_mata_pelajaran",
    "dim_mata_pelajaran": f"SELECT {key('nama_mata_pelajaran')} AS mata_pelajaran_key,"
    " nama_mata_pelajaran, CASE"
    " WHEN nama_mata_pelajaran IN ('Matematika', 'Fisika', 'Kimia', 'Biologi') THEN 'Sains'"
    " WHEN nama_mata_pelajaran IN ('Ekonomi', 'Sejarah', 'Geografi', 'Sosiologi') THEN 'Soshum'"
    " ELSE 'Bahasa/Lainnya' END AS kategori FROM subjects",
    "levels": "SELECT DISTINCT jenjang_standar AS nama_jenjang FROM ("
    " SELECT jenjang_standar FROM peta_pengguna_lintas_platform"
    " UNION ALL SELECT jenjang_standar FROM peta_kelas_lintas_platform)"
    " WHERE jenjang_standar IS NOT NULL",
    "dim_jenjang": f"SELECT {key('nama_jenjang')} AS jenjang_key, nama_jenjang,"
    " CASE nama_jenjang WHEN 'SD' THEN 1 WHEN 'SMP' THEN 2 WHEN 'SMA' THEN 3 ELSE 4 END AS tingkat"
    " FROM levels",
    "first_courses": "SELECT * FROM peta_kelas_lintas_platform"
    " QUALIFY row_number() OVER (PARTITION BY id_kelas_global"
    " ORDER BY id_platform, id_kelas_platform) = 1",
    "dim_kelas": f"SELECT {key('id_kelas_global')} AS kelas_key,"
    " id_kelas_global AS id_kelas_sumber, p.platform_key, c.nama_kelas_standar AS nama_kelas,"
    " m.mata_pelajaran_key, j.jenjang_key, c.tingkat_kesulitan_standar FROM first_courses c"
    " LEFT JOIN dim_platform p ON c.id_platform = p.id_platform"
    " LEFT JOIN dim_mata_pelajaran m ON c.mata_pelajaran_standar = m.nama_mata_pelajaran"
    " LEFT JOIN dim_jenjang j ON c.jenjang_standar = j.nama_jenjang",
    "devices": "SELECT DISTINCT perangkat_standar AS kategori_perangkat FROM ("
    " SELECT perangkat_standar FROM olah_aktivitas_belajar"
    " UNION ALL SELECT perangkat_standar FROM olah_ulasan)"
    " WHERE perangkat_standar IS NOT NULL AND lower(perangkat_standar) <> 'tidak diketahui'",
    "dim_perangkat": f"SELECT {key('kategori_perangkat')} AS perangkat_key, kategori_perangkat"
    " FROM devices",
    "packages": "SELECT DISTINCT nama_paket_standar AS jenis_paket FROM olah_transaksi"
    " WHERE nama_paket_standar IN ('gratis', 'reguler', 'premium')",
    "dim_paket": f"SELECT {key('jenis_paket')} AS paket_key, jenis_paket FROM packages",
    "methods": "SELECT DISTINCT metode_bayar_standar AS nama_metode FROM olah_transaksi"
    " WHERE metode_bayar_standar IS NOT NULL",
    "dim_metode_bayar": f"SELECT {key('nama_metode')} AS metode_bayar_key, nama_metode,"
    " " + label("nama_metode", v.PAYMENT_METHOD_CATEGORIES, "'lainnya'") + " AS kategori_metode"
    " FROM methods",
}

_LOOKUPS = {
    "platform": "LEFT JOIN dim_platform p ON e.id_platform = p.id_platform",
    "pengguna": "LEFT JOIN dim_pengguna u ON e.id_pengguna_global = u.id_pengguna_sumber",
    "kelas": "LEFT JOIN dim_kelas k ON e.id_kelas_global = k.id_kelas_sumber",
    "perangkat": "LEFT JOIN dim_perangkat d ON e.perangkat_standar = d.kategori_perangkat",
    "paket": "LEFT JOIN dim_paket pk ON e.nama_paket_standar = pk.jenis_paket",
    "metode_bayar": "LEFT JOIN dim_metode_bayar m ON e.metode_bayar_standar = m.nama_metode",
}


def _fact(events: str, day: str, lookups: list[str], columns: str) -> str:
    keys = ", ".join(
        {"platform": "p", "pengguna": "u", "kelas": "k", "perangkat": "d", "paket": "pk",
         "metode_bayar": "m"}[name] + f".{name}_key"
        for name in lookups
    )
    joins = " ".join(_LOOKUPS[name] for name in lookups)
    return (
        f"SELECT w.waktu_key, {keys}, {columns} FROM {events} e"
        f" LEFT JOIN dim_waktu w ON e.{day} = w.tanggal {joins}"
    )


def _flag(column: str, wanted: str) -> str:
    return f"CASE WHEN {column} = '{wanted}' THEN 1 ELSE 0 END AS {wanted}_flag"


_STATE, _PAID = "e.status_pendaftaran_standar", "e.status_bayar_standar"
CTES.update(
    {
        "fakta_pendaftaran_program": _fact(
            "olah_pendaftaran_program", "tanggal_daftar", ["platform", "pengguna", "kelas"],
            f"e.id_pendaftaran AS id_pendaftaran_sumber, {_STATE} AS status_pendaftaran,"
            f" {_flag(_STATE, 'aktif')}, {_flag(_STATE, 'batal')}",
        ),
        "fakta_aktivitas_belajar": _fact(
            "olah_aktivitas_belajar", "tanggal_aktivitas",
            ["platform", "pengguna", "kelas", "perangkat"],
            "e.id_aktivitas AS id_aktivitas_sumber,"
            " trunc(e.durasi_belajar_menit)::INTEGER AS durasi_menit",
        ),
        "fakta_hasil_latihan": _fact(
            "olah_hasil_latihan", "tanggal_latihan", ["platform", "pengguna", "kelas"],
            f"e.id_hasil AS id_hasil_sumber, e.nilai_standar, e.status_lulus,"
            f" {_flag('e.status_lulus', 'lulus')}",
        ),
        "fakta_transaksi": _fact(
            "olah_transaksi", "tanggal_transaksi",
            ["platform", "pengguna", "paket", "metode_bayar"],
            f"e.id_transaksi AS id_transaksi_sumber, e.jumlah_bayar, {_PAID} AS status_bayar,"
            f" {_flag(_PAID, 'berhasil')}, {_flag(_PAID, 'gagal')}, {_flag(_PAID, 'pending')}",
        ),
        "fakta_ulasan": _fact(
            "olah_ulasan", "tanggal_ulasan", ["platform", "pengguna", "kelas"],
            "e.id_ulasan AS id_ulasan_sumber, e.rating_standar_5,"
            " CASE WHEN e.komentar IS NOT NULL THEN 1 ELSE 0 END AS komentar_tersedia_flag",
        ),
    }
)


CTES["fakta_pendaftaran_all"] = CTES["fakta_pendaftaran_program"].replace("dim_waktu", "dim_waktu_all")


def statement(select: str) -> str:
    """``select`` preceded by the named subqueries that it needs, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\b[a-z_0-9]+\b", text)) & CTES.keys():
            if name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(select)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {ctes}\n{select}"


def whole(table: str) -> str:
    return statement(f"SELECT * FROM {table}")
