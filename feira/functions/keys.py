from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what stands between the parts of a composite key.
KEY_SEPARATOR = "||"


def key_text(*parts) -> Column:
    """Parts joined into one string. Null parts are skipped; all null gives ''."""
    return F.concat_ws(KEY_SEPARATOR, *parts)


def surrogate_key(*parts) -> Column:
    """SHA-256 of the key text as 64 hex digits. Never null: see ``key_text``."""
    return F.sha2(key_text(*parts), 256)


def known_key(natural: str) -> Column:
    """The surrogate key of one natural key, or null where that is null."""
    return F.when(F.col(natural).isNotNull(), surrogate_key(natural))


def date_key(moment) -> Column:
    """Calendar day as ``yyyyMMdd`` text, the key of ``dim_date``."""
    return F.date_format(moment, "yyyyMMdd")
