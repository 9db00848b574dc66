"""Row hashing, column encryption and JSON shaping (HSH1, CRY1, CRY2, JSN1-JSN3).

Key material is passed as a one-row DataFrame and joined in, so it never
appears as a literal in plan strings or generated column names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Separator between hashed fields (unit separator, chr 31), the
# marker of NULL (a value starts with its length), and the token written for a
# value that cannot be decrypted ("decryption error").
HASH_SEPARATOR = "\x1f"
HASH_NULL = "~"
DECRYPT_ERROR = "ERREUR DE DÉCHIFFREMENT"


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """HSH1: md5 over the listed columns, each as length and exact text, nulls marked.

    A 128-bit hash instead of a 32-bit checksum.  A double's text is exact (it
    reads back as the same double; -0.0 counts as 0.0), and no value's text equals
    the mark of NULL or runs into the next field.
    """
    types = dict(df.dtypes)
    parts = []
    for c in columns:
        col = F.col(c)
        if types[c] in ("double", "float"):
            col = col + F.lit(0.0)
        text = col.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit(HASH_NULL)))
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def key_frame(spark, key: bytes, name: str = "__k") -> DataFrame:
    """One-row frame holding the key; broadcast-joined where needed."""
    return spark.createDataFrame([(bytearray(key),)], T.StructType([T.StructField(name, T.BinaryType(), False)]))


def with_key(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.crossJoin(F.broadcast(keys))


def encrypt_column(value: Column, key: Column) -> Column:
    """CRY1: AES-256-CBC with a random IV in front of the ciphertext, base64 text."""
    return F.base64(F.aes_encrypt(value.cast("binary"), key, F.lit("CBC"), F.lit("PKCS")))


def decrypt_column(value: Column, key: Column, error_token: str = DECRYPT_ERROR) -> Column:
    """CRY2: decrypt base64 text; one error token per row that cannot be read."""
    raw = F.try_to_binary(value, F.lit("base64"))
    plain = F.try_aes_decrypt(raw, key, F.lit("CBC"), F.lit("PKCS"))
    return F.coalesce(F.try_validate_utf8(plain.cast("string")), F.lit(error_token))


def to_json_record(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """JSN1: a record as JSON text (timestamps in ISO form)."""
    cols = columns or df.columns
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def with_default_field(df: DataFrame, field: str, default: str) -> DataFrame:
    """JSN2: keep every field, add one with a default value when it is missing."""
    if field in df.columns:
        return df.withColumn(field, F.coalesce(F.col(field), F.lit(default)))
    return df.withColumn(field, F.lit(default))


def from_json_record(c: Column, schema: T.StructType) -> Column:
    """JSN3: JSON text back to a typed record with a declared schema."""
    return F.from_json(c, schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"})
