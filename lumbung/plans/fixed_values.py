"""Fixed values of this integration: dictionaries, labels, thresholds.

These are data, not design.  They have to equal the values the existing target
tables were filled with, so that old and new rows can stand side by side.
"""

from __future__ import annotations

from lumbung.functions.standardize import Mapping

# ---------------------------------------------------------------- fixed values
# The platforms: source code -> (platform id, name, kind).
PLATFORMS = {
    "zb": ("PLT-ZB", "ZeniBelajar", "MySQL/Web"),
    "rc": ("PLT-RC", "RuangCerdas", "PostgreSQL/Web"),
    "kj": ("PLT-KJ", "KelasJuara", "MongoDB/Web"),
    "pn": ("PLT-PN", "PintarNusa", "CSV/Web"),
}

# Difficulty levels.
LEVELS = {
    "beginner": "dasar",
    "intermediate": "menengah",
    "advanced": "lanjut",
    "easy": "dasar",
    "medium": "menengah",
    "hard": "lanjut",
    "pemula": "dasar",
    "sedang": "menengah",
    "mahir": "lanjut",
    "dasar": "dasar",
    "menengah": "menengah",
    "lanjut": "lanjut",
}

# Subjects, English to Indonesian.
SUBJECTS = {
    "Mathematics": "Matematika",
    "Physics": "Fisika",
    "Chemistry": "Kimia",
    "Biology": "Biologi",
    "English": "Bahasa Inggris",
    "Indonesian": "Bahasa Indonesia",
    "Economics": "Ekonomi",
    "History": "Sejarah",
    "Geography": "Geografi",
    "Sociology": "Sosiologi",
    "Mathematics (Saintek)": "Matematika",
    "English (General)": "Bahasa Inggris",
}

# Status of an enrolment.
REGISTRATION_STATUS = {
    "aktif": "aktif",
    "active": "aktif",
    "selesai": "selesai",
    "completed": "selesai",
    "batal": "batal",
    "cancelled": "batal",
    "dropout": "tidak_aktif",
    "nonaktif": "tidak_aktif",
}

# Category of a payment method.
PAYMENT_METHOD_CATEGORIES = {
    "e-wallet": "pembayaran digital",
    "QRIS": "pembayaran digital",
    "GoPay": "pembayaran digital",
    "OVO": "pembayaran digital",
    "ShopeePay": "pembayaran digital",
    "transfer_bank": "transfer",
    "bank_transfer": "transfer",
    "virtual_account": "transfer",
    "kartu_kredit": "kartu",
    "credit_card": "kartu",
    "minimarket": "retail",
    "alfamart": "retail",
    "indomaret": "retail",
    "gratis": "gratis",
    "free": "gratis",
}

# Status of a payment.
PAYMENT_STATUS = {
    "paid": "berhasil",
    "berhasil": "berhasil",
    "gagal": "gagal",
    "pending": "pending",
    "success": "berhasil",
    "failed": "gagal",
    "unpaid": "gagal",
    "cancelled": "gagal",
    "lunas": "berhasil",
    "menunggu": "pending",
    "belum": "pending",
    "batal": "gagal",
}

# Payment methods.
PAYMENT_METHODS = {
    "GoPay": "e-wallet",
    "transfer": "transfer",
    "transfer_bank": "transfer",
    "e-wallet": "e-wallet",
    "kartu": "kartu",
    "kartu_kredit": "kartu",
    "minimarket": "minimarket",
    "QRIS": "e-wallet",
    "gratis": "gratis",
    "virtual_account": "transfer",
    "bank_transfer": "transfer",
    "e_wallet": "e-wallet",
}

# Subscription packages.
PACKAGES = {
    "Gratis": "gratis",
    "Reguler": "reguler",
    "Premium": "premium",
    "Standard": "reguler",
    "Premium Plus": "premium",
    "Free": "gratis",
    "Pro": "reguler",
    "Elite": "premium",
    "Basic": "reguler",
    "Super": "premium",
}

# Devices.
DEVICES = {
    "desktop": "desktop",
    "web": "desktop",
    "browser": "desktop",
    "windows": "desktop",
    "mac": "desktop",
    "mobile": "mobile",
    "smartphone": "mobile",
    "phone": "mobile",
    "android": "mobile",
    "ios": "mobile",
    "iphone": "mobile",
    "tablet": "tablet",
    "ipad": "tablet",
    "unknown": "tidak diketahui",
    "": "tidak diketahui",
    "null": "tidak diketahui",
}

# Month names.
MONTH_NAMES = {
    1: "Januari",
    2: "Februari",
    3: "Maret",
    4: "April",
    5: "Mei",
    6: "Juni",
    7: "Juli",
    8: "Agustus",
    9: "September",
    10: "Oktober",
    11: "November",
    12: "Desember",
}

# School levels of the document source, and the rank of a school level.
SCHOOL_LEVEL_NAMES = {"Junior High": "SMP", "Senior High": "SMA"}
SCHOOL_LEVEL_RANKS = {"SD": 1, "SMP": 2, "SMA": 3}
OTHER_SCHOOL_LEVEL_RANK = 4

# Categories of subjects.
SUBJECT_CATEGORIES = {
    "Sains": ("Matematika", "Fisika", "Kimia", "Biologi"),
    "Soshum": ("Ekonomi", "Sejarah", "Geografi", "Sosiologi"),
}
OTHER_SUBJECT_CATEGORY = "Bahasa/Lainnya"

# Labels and thresholds.
UNKNOWN_DEVICE = "tidak diketahui"
PACKAGE_LABELS = ("gratis", "reguler", "premium")
PASS_MARKS = {"zb": 70, "rc": 70, "pn": 75}
HOME_ISLAND_PATTERN = "Jawa|Jakarta|Banten|Yogyakarta"

# Reports on the sources: full marks where they are not 100, labels of the free
# package, expected devices, session length in minutes, subjects of the science check.
FULL_MARKS = {"zb": 1000}
FREE_PACKAGES = {"zb": "Gratis", "rc": "Gratis", "kj": "Free", "pn": "Gratis"}
REVIEW_DEVICES = ("ios", "web", "android")
SESSION_MINUTES = (5, 20)
SCIENCE_SUBJECTS = ("Mathematics", "Physics", "Chemistry")
# ----------------------------------------------------------------------------

LEVEL = Mapping("level", LEVELS)
LEVEL_OR_SOURCE = LEVEL.using(normalize=True, on_miss="source")
SUBJECT = Mapping("subject", SUBJECTS, on_miss="source")
ENROLMENT_STATUS = Mapping(
    "enrolment status", REGISTRATION_STATUS, normalize=True, on_miss="literal", default="aktif"
)
PAYMENT_STATE = Mapping("payment status", PAYMENT_STATUS, on_miss="literal", default="Unknown")
PAYMENT_METHOD = Mapping("payment method", PAYMENT_METHODS)
PACKAGE = Mapping("package", PACKAGES, on_miss="source")
DEVICE = Mapping("device", DEVICES, normalize=True, on_miss="literal", default=UNKNOWN_DEVICE)
METHOD_CATEGORY = Mapping(
    "payment method category", PAYMENT_METHOD_CATEGORIES, on_miss="literal", default="lainnya"
)
