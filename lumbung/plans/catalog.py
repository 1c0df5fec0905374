"""How each source table becomes rows of each conformed table.

This is configuration: one entry per target table and source.  The tables,
columns and id prefixes named here are fixed values: they are those of the sources.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from lumbung.plans import fixed_values as v
from lumbung.plans.fields import (
    Field,
    amount,
    date,
    device,
    event_id,
    graded,
    hashed,
    key,
    label,
    place,
    recoded,
    source,
)

MINUTES, SCORE, MONEY, RATING = "decimal(10,2)", "decimal(5,2)", "decimal(15,2)", "decimal(3,1)"
NO_TEACHER = "Tidak Diketahui"


@dataclass(frozen=True)
class TableFields:
    """The source table and the target columns computed from it."""

    table: str
    fields: Mapping[str, Field]


def _user(table, id_, email, name, level, grade, province, registered) -> TableFields:
    return TableFields(
        table,
        {
            "id_pengguna_platform": key(id_),
            "email_hash": hashed(email),
            "email_asli": source(email),
            "nama_standar": source(name),
            "jenjang_standar": source(level),
            "kelas_sekolah_standar": key(*grade),
            "provinsi_standar": place(*province),
            "tanggal_daftar": date(*registered),
        },
    )


USERS = {
    "zb": _user(
        "member", "kode_member", "alamat_email", "nama_lengkap", "level_sekolah",
        ["tingkat_kelas"], ["domisili"], ["waktu_registrasi"],
    ),
    "rc": _user(
        "siswa", "id_siswa", "email", "nama_siswa", "jenjang",
        ["kelas_sekolah", "kelas"], ["domisili_provinsi", "kota"],
        ["tanggal_daftar", "tanggal_registrasi"],
    ),
    "kj": _user(
        "pengguna", "user_id", "email_user", "nama", "jenjang_pendidikan",
        ["kelas"], ["asal_provinsi"], ["created_date"],
    ),
    "pn": _user(
        "siswa_pintarnusa", "id_siswa", "email", "nama_siswa", "tingkat_pendidikan",
        ["kelas_tingkat"], ["provinsi"], ["tanggal_gabung"],
    ),
}


def _course(table, id_, subject, level, difficulty: Field, teacher: Field) -> TableFields:
    return TableFields(
        table,
        {
            "id_kelas_platform": key(id_),
            "mata_pelajaran_sumber": source(subject),
            "mata_pelajaran_standar": label(v.SUBJECT, subject),
            "jenjang_standar": level,
            "tingkat_kesulitan_standar": difficulty,
            "pengajar": teacher,
        },
    )


COURSES = {
    "zb": _course(
        "program_belajar", "kode_program", "mapel", source("target_jenjang"),
        label(v.LEVEL, "kategori_level"), source("mentor"),
    ),
    "rc": _course(
        "kelas", "id_kelas", "mata_pelajaran", source("jenjang"),
        label(v.LEVEL_OR_SOURCE, "tingkat_kesulitan", "tingkat", default="menengah"),
        source("pengajar", "instruktur", "guru", default=NO_TEACHER),
    ),
    "kj": _course(
        "produk_kelas", "produk_id", "subject_name",
        recoded(v.SCHOOL_LEVEL_NAMES, "school_level"),
        label(v.LEVEL, "difficulty"), source("tutor_name"),
    ),
    "pn": _course(
        "katalog_program", "id_program", "bidang_studi", source("jenjang"),
        label(v.LEVEL, "level_kesulitan"), source("pengajar"),
    ),
}

# The user and course columns of each source's event tables.
USER_ID = {"zb": "kode_member", "rc": "id_siswa", "kj": "user_id", "pn": "id_siswa"}
COURSE_ID = {"zb": "kode_program", "rc": "id_kelas", "kj": "produk_id", "pn": "id_program"}

# An event's id is "<source>-<kind>-<native id>".
ACTIVITY_SOURCES = {
    "zb": TableFields(
        "riwayat_belajar",
        {
            "id_aktivitas": event_id("ZB-AK-", "id_riwayat"),
            "tanggal_aktivitas": date("waktu_mulai"),
            "durasi_belajar_menit": amount(MINUTES, "lama_belajar_detik", divided_by=60),
            "perangkat_standar": device(v.DEVICE, "device"),
        },
    ),
    "rc": TableFields(
        "log_video",
        {
            "id_aktivitas": event_id("RC-AK-", "id_log"),
            "tanggal_aktivitas": date("tanggal_akses", "waktu_mulai"),
            "durasi_belajar_menit": amount(MINUTES, "durasi_tonton_menit", "durasi_menit"),
            "perangkat_standar": device(v.DEVICE, "perangkat", "device"),
        },
    ),
    "kj": TableFields(
        "akses_materi",
        {
            "id_aktivitas": event_id("KJ-AK-", "akses_id"),
            "tanggal_aktivitas": date("tanggal"),
            "durasi_belajar_menit": amount(MINUTES, "watch_time", times=60),
            "perangkat_standar": device(v.DEVICE, "platform_device"),
        },
    ),
    "pn": TableFields(
        "sesi_belajar",
        {
            "id_aktivitas": event_id("PN-AK-", "id_sesi"),
            "tanggal_aktivitas": date("tanggal_sesi"),
            "durasi_belajar_menit": amount(MINUTES, "durasi_menit"),
            "perangkat_standar": device(v.DEVICE, "perangkat"),
        },
    ),
}

RESULT_SOURCES = {
    "zb": TableFields(
        "nilai_tryout",
        {
            "id_hasil": event_id("ZB-HL-", "id_tryout"),
            "tanggal_latihan": date("tanggal_submit"),
            "nilai_standar": amount(SCORE, "skor", divided_by=10),
            "status_lulus": graded(v.PASS_MARKS["zb"], "skor", divided_by=10),
        },
    ),
    "rc": TableFields(
        "hasil_kuis",
        {
            "id_hasil": event_id("RC-HL-", "id_hasil", "id_kuis"),
            "tanggal_latihan": date("tanggal_kuis"),
            "nilai_standar": amount(SCORE, "nilai"),
            "status_lulus": graded(v.PASS_MARKS["rc"], "nilai"),
        },
    ),
    "kj": TableFields(
        "skor_evaluasi",
        {
            "id_hasil": event_id("KJ-HL-", "evaluasi_id"),
            "tanggal_latihan": date("tanggal_evaluasi"),
            "nilai_standar": amount(SCORE, "score_percent"),
            # this source states the result itself; all but "lulus" is a failure
            "status_lulus": lambda df: v.Mapping(
                "result", {"lulus": "lulus"}, on_miss="literal", default="tidak_lulus"
            )(df["status_lulus"]),
        },
    ),
    "pn": TableFields(
        "hasil_assessment",
        {
            "id_hasil": event_id("PN-HL-", "id_assessment"),
            "tanggal_latihan": date("tanggal_assessment"),
            "nilai_standar": amount(SCORE, "nilai_akhir"),
            "status_lulus": graded(v.PASS_MARKS["pn"], "nilai_akhir"),
        },
    ),
}


def _payment(table, prefix, id_, paid_on, package, method, total, state) -> TableFields:
    return TableFields(
        table,
        {
            "id_transaksi": event_id(prefix, id_),
            "tanggal_transaksi": date(*paid_on),
            "nama_paket_standar": label(v.PACKAGE, package),
            "metode_bayar_standar": label(v.PAYMENT_METHOD, *method),
            "jumlah_bayar": amount(MONEY, *total),
            "status_bayar_standar": label(v.PAYMENT_STATE, *state),
        },
    )


PAYMENT_SOURCES = {
    "zb": _payment(
        "order_langganan", "ZB-TR-", "id_order", ["tanggal_order"], "paket",
        ["channel_pembayaran"], ["total_harga"], ["status_order"],
    ),
    "rc": _payment(
        "transaksi_paket", "RC-TR-", "id_transaksi", ["tanggal_bayar", "tanggal_transaksi"],
        "nama_paket", ["metode_bayar", "metode_pembayaran"], ["jumlah_bayar", "harga"],
        ["status_bayar", "status_transaksi"],
    ),
    "kj": _payment(
        "invoice_pembayaran", "KJ-TR-", "invoice_id", ["tanggal_invoice"], "nama_produk_paket",
        ["payment_type"], ["amount"], ["payment_status"],
    ),
    "pn": _payment(
        "tagihan_program", "PN-TR-", "id_tagihan", ["tanggal_tagihan"], "nama_paket",
        ["metode_bayar"], ["nominal"], ["status_tagihan"],
    ),
}


def _review(table, prefix, id_, written_on, rating: Field, comment, devices) -> TableFields:
    return TableFields(
        table,
        {
            "id_ulasan": event_id(prefix, id_),
            "tanggal_ulasan": date(written_on),
            "rating_standar_5": rating,
            "komentar": source(comment),
            "perangkat_standar": device(v.DEVICE, *devices),
        },
    )


def review_sources(more_device_columns: tuple[str, ...] = ()) -> dict[str, TableFields]:
    """Two sources call their device column otherwise than expected here, so their
    reviews have an unknown device.  ``more_device_columns=("device",)`` reads it."""
    more = more_device_columns
    return {
        "zb": _review(
            "feedback_program", "ZB-UL-", "id_feedback", "tanggal_feedback",
            amount(RATING, "skor_rating", divided_by=2), "ulasan_text", ["device", *more],
        ),
        "rc": _review(
            "ulasan_kelas", "RC-UL-", "id_ulasan", "tanggal_ulasan",
            amount(RATING, "rating"), "komentar", ["perangkat", "device", *more],
        ),
        "kj": _review(
            "review_kelas", "KJ-UL-", "review_id", "review_date",
            amount(RATING, "star_rating"), "review_text", ["platform_device", *more],
        ),
        "pn": _review(
            "ulasan_program", "PN-UL-", "id_ulasan", "tanggal_ulasan",
            amount(RATING, "rating"), "isi_ulasan", ["perangkat", *more],
        ),
    }


def _enrolment(table, prefix, ids, dates, states) -> TableFields:
    return TableFields(
        table,
        {
            "id_pendaftaran": event_id(prefix, *ids),
            "tanggal_daftar": date(*dates),
            "status_pendaftaran_standar": label(v.ENROLMENT_STATUS, *states),
        },
    )


ENROLMENT_SOURCES = {
    "zb": _enrolment(
        "peserta_program", "ZB-PD-", ["id_peserta", "kode_peserta"],
        ["tanggal_daftar", "waktu_daftar"], ["status_peserta", "status_aktif"],
    ),
    "rc": _enrolment(
        "pendaftaran_kelas", "RC-PD-", ["id_pendaftaran", "id_daftar"],
        ["tanggal_daftar", "tanggal_registrasi"], ["status", "status_pendaftaran"],
    ),
    "kj": _enrolment(
        "pembelian_kelas", "KJ-PD-", ["pembelian_id"],
        ["tanggal_beli", "purchase_date"], ["status_pembelian", "status"],
    ),
    "pn": _enrolment(
        "enrolmen_program", "PN-PD-", ["id_enrol", "id_enrolmen"],
        ["tanggal_enrol", "waktu_enrol"], ["status_aktif", "status"],
    ),
}
