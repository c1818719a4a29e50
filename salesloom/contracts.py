"""Fixed business contracts shared by every job.

All values in this module are fixed values: column names, enumerations,
messages and limits that results have to agree on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Channel:
    """One sales channel: its code, labels and native column names."""

    key: str
    code: str
    label: str
    kind: str
    raw_table: str
    file_name: str
    fields: dict = field(hash=False)  # canonical name -> native column

    @property
    def order_column(self) -> str:
        return self.fields["order_id"]

    @property
    def line_column(self) -> str:
        return self.fields["line_number"]

    @property
    def required_columns(self) -> list[str]:
        return list(self.fields.values())

    @property
    def all_columns(self) -> list[str]:
        return self.required_columns + list(OPTIONAL_FIELDS)


# Optional columns of every channel file.
OPTIONAL_FIELDS = ("discount_amount", "promo_code")

# Native column names of the four channel exports.
CHANNELS = {
    "shopee": Channel(
        "shopee", "SHOPEE", "Shopee", "MARKETPLACE", "raw_shopee_orders", "shopee.csv",
        {
            "order_id": "order_id", "line_number": "order_line_id", "order_date": "order_date",
            "product_input": "product_name", "quantity": "qty", "unit_price": "unit_price",
            "customer_name": "customer_name", "customer_city": "customer_city",
            "payment_method": "payment_method", "status": "status",
        },
    ),
    "tokopedia": Channel(
        "tokopedia", "TOKOPEDIA", "Tokopedia", "MARKETPLACE", "raw_tokopedia_transactions", "tokopedia.csv",
        {
            "order_id": "transaction_id", "line_number": "item_sequence", "order_date": "transaction_date",
            "product_input": "item_name", "quantity": "quantity", "unit_price": "price",
            "customer_name": "buyer_name", "customer_city": "city",
            "payment_method": "payment", "status": "status",
        },
    ),
    "website": Channel(
        "website", "WEBSITE", "Website", "DIRECT", "raw_website_transactions", "website.csv",
        {
            "order_id": "invoice_no", "line_number": "line_item_no", "order_date": "created_at",
            "product_input": "product_identifier", "quantity": "quantity", "unit_price": "unit_price",
            "source_total_amount": "total_amount", "customer_email": "customer_email", "status": "status",
        },
    ),
    "offline": Channel(
        "offline", "OFFLINE_STORE", "Offline Store", "OFFLINE", "raw_offline_store_sales", "offline.csv",
        {
            "order_id": "pos_receipt_no", "line_number": "receipt_line_no", "order_date": "sold_at",
            "product_input": "item_description", "quantity": "units", "unit_price": "item_price",
            "store_name": "store_name", "store_city": "store_city",
            "payment_method": "payment_type", "status": "status",
        },
    ),
}
CHANNEL_CODES = tuple(c.code for c in CHANNELS.values())
CHANNEL_BY_CODE = {c.code: c for c in CHANNELS.values()}

# Older native column names still accepted, (channel, old, new).
LEGACY_COLUMNS = (
    ("shopee", "order_status", "status"),
    ("tokopedia", "trans_date", "transaction_date"),
    ("tokopedia", "amount", "price"),
    ("offline", "sale_status", "status"),
)

# Canonical text fields a channel file may supply.
CANONICAL_FIELDS = (
    "order_id", "line_number", "order_date", "product_input", "quantity", "unit_price",
    "source_total_amount", "customer_name", "customer_email", "customer_city", "store_name",
    "store_city", "payment_method", "status", "discount_amount", "promo_code",
)
OPTIONAL_WARNED_FIELDS = (
    "customer_name", "customer_email", "customer_city", "store_name", "store_city", "payment_method",
)
LINEAGE = ("source", "source_file", "source_row_number", "source_sha256")

# Canonical sales columns, in order.
SALES_COLUMNS = (
    "source", "order_id", "line_number", "order_date", "sku", "product_name", "brand", "category",
    "quantity", "unit_price", "gross_amount", "discount_amount", "net_amount", "promo_code",
    "source_total_amount", "customer_name", "customer_email", "customer_city", "store_name",
    "store_city", "payment_method", "status",
) + LINEAGE[1:]
CLEAN_PRODUCT_COLUMNS = ("product_id", "product_name", "brand", "kategori", "harga_satuan")
CLEAN_SALES_COLUMNS = (
    "order_id", "line_number", "product_id", "product_name", "kategori", "quantity", "total_harga",
    "tanggal_order", "kota", "channel", "status", "customer_email", "harga_satuan",
    "discount_amount", "net_amount", "promo_code",
)

# Reference-file contracts.
PRODUCT_COLUMNS = ("sku", "product_name", "brand", "category", "price")
PRODUCT_FILE, LEGACY_PRODUCT_FILE = "product_master.csv", "product.csv"
PROMO_COLUMNS = (
    "promo_code", "promo_name", "discount_type", "discount_value", "start_date", "end_date", "status",
)
PROMO_FILE = "promo_master.csv"
RETURN_COLUMNS = (
    "source_name", "return_id", "return_line_number", "order_id", "order_line_number", "return_date",
    "return_reason", "return_status", "quantity_returned", "refund_amount", "refund_status",
)
RETURN_FILE, LEGACY_RETURN_FILE = "return_refund.csv", "returns.csv"
MANIFEST_FILE = "source_manifest.json"

# Enumerations.
SALE_STATUSES = ("COMPLETED", "CANCELLED", "RETURNED")
ELIGIBLE_STATUSES = ("COMPLETED", "RETURNED")
PROMO_KINDS = ("fixed", "percentage")
PROMO_STATUSES = ("active", "expired", "paused")
RETURN_STATUSES = ("PENDING", "APPROVED", "REJECTED", "PROCESSED")
REFUND_STATUSES = ("NOT_APPLICABLE", "PENDING", "PROCESSED", "FAILED")
SEVERITIES = ("INFO", "WARNING", "ERROR")
MISSING_MARKERS = ("", "null", "none", "nan", "n/a", "na")
CITIES = ("Jakarta", "Bandung", "Surabaya", "Yogyakarta", "Semarang", "Medan", "Makassar", "Denpasar")
PAYMENTS = ("Transfer Bank", "E-Wallet", "Credit Card", "COD", "Cash")
CHANNEL_ALIASES = {
    "SHOPEE": "SHOPEE", "TOKOPEDIA": "TOKOPEDIA", "WEBSITE": "WEBSITE",
    "OFFLINE": "OFFLINE_STORE", "OFFLINE_STORE": "OFFLINE_STORE",
}
CHECK_GROUPS = {
    "missing": ("MISSING_REQUIRED", "MISSING_OPTIONAL"),
    "duplicate": ("DUPLICATE_BUSINESS_KEY", "CONFLICTING_DUPLICATE"),
    "invalid": (
        "INVALID_NUMBER", "NON_POSITIVE", "INVALID_INTEGER", "INVALID_MONEY_PRECISION_OR_RANGE",
        "NEGATIVE_AMOUNT", "DISCOUNT_EXCEEDS_GROSS", "AMOUNT_MISMATCH", "INVALID_STATUS",
        "PRICE_DIFFERS_FROM_MASTER", "INVALID_EMAIL", "INVALID_LINE_NUMBER", "UNKNOWN_PAYMENT",
    ),
    "date": ("INVALID_DATE",),
    "product": ("UNMAPPED_PRODUCT",),
}
INT_MAX = 2147483647
MONEY_MAX = "999999999999.99"
REFUND_MAX = "99999999999999.99"

# Rejection texts of return events, by rule.
RETURN_REASONS = {
    "channel": "source_name harus SHOPEE, TOKOPEDIA, WEBSITE, atau OFFLINE_STORE",
    "required": "return_id, order_id, dan return_reason wajib diisi",
    "date": "return_date harus berformat YYYY-MM-DD",
    "return_status": "return_status harus salah satu dari APPROVED, PENDING, PROCESSED, REJECTED",
    "refund_status": "refund_status harus salah satu dari FAILED, NOT_APPLICABLE, PENDING, PROCESSED",
    "refund_required": "refund_amount wajib diisi jika refund_status PROCESSED",
    "refund_number": "refund_amount harus berupa angka desimal",
    "refund_negative": "refund_amount tidak boleh negatif",
    "refund_range": "refund_amount melebihi batas NUMERIC(16,2)",
    "refund_precision": "refund_amount maksimal dua angka desimal",
    "refund_early": "refund_amount hanya diisi setelah refund_status PROCESSED",
    "refund_open": "Refund tidak dapat berstatus PROCESSED untuk retur PENDING atau REJECTED",
    "return_line_number": "return_line_number harus bilangan bulat positif",
    "order_line_number": "order_line_number harus bilangan bulat positif",
    "quantity_returned": "quantity_returned harus bilangan bulat positif",
    "conflict": "Business key retur duplikat dalam file",
    "no_sale": "Baris penjualan asal tidak ditemukan di Warehouse",
    "cancelled": "Retur tidak dapat merujuk ke penjualan CANCELLED",
    "quantity_cap": "Jumlah retur kumulatif melebihi quantity terjual",
    "refund_cap": "Refund kumulatif melebihi net amount baris penjualan",
}

# Why a source is not reconciled.
RECONCILE_SKIPS = {
    "declaration": "sumber bukan FULL_SNAPSHOT lengkap dengan scope ALL_HISTORY",
    "partial": "snapshot sumber tidak lengkap",
    "columns": "kolom business key tidak tersedia",
    "key": "ada baris dengan business key yang tidak dapat ditentukan",
    "range": "ada nomor baris di luar batas yang didukung",
}

PIPELINE_NAME = "retail_sales"
MONEY14, MONEY16 = T.DecimalType(14, 2), T.DecimalType(16, 2)
ISSUE_TYPE = "struct<severity:string,rule:string,field:string,raw_value:string>"


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
