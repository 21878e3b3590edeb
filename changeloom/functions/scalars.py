"""Scalar helpers of the codecs, sinks and rules as column expressions."""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def quote_name(name: Column) -> Column:
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))


def where_clause(keys: list[str]) -> Column:
    """Condition text on the key columns; a null key is tested with IS NULL."""
    part = lambda k: F.concat(F.lit(f"`{k}` "), F.coalesce(F.concat(F.lit("= "), F.col(k).cast("string")), F.lit("IS NULL")))
    return F.concat_ws(" AND ", *[part(k) for k in keys])


def choose_key(candidates: list[tuple[str, list[Column]]]) -> Column:
    """Name of the first key whose values are all present, else ``none``."""
    out = F.lit("none")
    for name, cols in reversed(candidates):
        full = F.lit(True)
        for c in cols:
            full = full & c.isNotNull()
        out = F.when(full, F.lit(name)).otherwise(out)
    return out


def eligible(pk: Column, uk_not_null: Column, view: Column, sequence: Column, force: bool = False) -> Column:
    return ~sequence & (view | pk | uk_not_null | F.lit(force))


def value_string(v: Column, kind: str) -> Column:
    """Text of a value: booleans as 1 and 0, floats without an exponent."""
    if kind == "boolean":
        return F.when(v, "1").otherwise("0")
    if kind == "double":
        return _plain_double(v)
    return v.cast("string")


def _plain_double(v: Column) -> Column:
    """The shortest digits of a double, written out without an exponent."""
    text = F.regexp_replace(v.cast("string"), r"\.0$", "")
    form = r"^-?(\d)\.(\d+)E(-?\d+)$"
    part = lambda i: F.regexp_extract(text, form, i)
    tail = F.regexp_replace(part(2), r"^0$", "")
    power = part(3).try_cast("int")
    zeros = lambda n: F.repeat(F.lit("0"), F.greatest(n, F.lit(0)))
    whole = F.concat(part(1), F.substring(tail, F.lit(1), power), zeros(power - F.length(tail)))
    rest = F.substring(tail, power + 1, F.length(tail))
    big = F.concat(whole, F.when(F.length(rest) > 0, F.concat(F.lit("."), rest)).otherwise(""))
    small = F.concat(F.lit("0."), zeros(-power - 1), part(1), tail)
    sign = F.when(text.startswith("-"), "-").otherwise("")
    return F.when(v == 0, "0").when(power.isNull(), text).otherwise(F.concat(sign, F.when(power >= 0, big).otherwise(small)))


def collated_key(value: Column, collation: Column) -> Column:
    """Key text: lower case under a case-insensitive collation."""
    return F.when(collation.endswith("_ci"), F.lower(value)).otherwise(value)


def record_name(name: Column) -> Column:
    """A name that starts with a letter or ``_`` and has no other characters."""
    return F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9_]", "_"), "^([0-9])", "_$1")


def type_name(base: Column, unsigned: Column, args: Column | None = None) -> Column:
    name = base if args is None else F.concat(base, F.coalesce(F.concat(F.lit("("), args, F.lit(")")), F.lit("")))
    return F.concat(name, F.when(unsigned, " unsigned").otherwise(""))


#: JDBC type codes, fixed values of the Java standard.
JAVA_TYPES = {
    "tinyint": -6, "smallint": 5, "mediumint": 4, "int": 4, "bigint": -5, "float": 7, "double": 8, "decimal": 3, "char": 1,
    "varchar": 12, "binary": 2004, "varbinary": 2004, "blob": 2004, "text": 2005, "date": 91, "datetime": 93, "timestamp": 93,
    "time": 92, "year": 12, "bit": -7, "enum": 4, "set": -7, "json": 12,
}


def java_type(base: Column, unsigned: Column) -> Column:
    """JDBC code; an unsigned integer takes the next wider one."""
    codes = F.create_map(*[F.lit(x) for kv in JAVA_TYPES.items() for x in kv])
    wider = F.when(base == "tinyint", 5).when(base == "smallint", 4).when(base.isin("mediumint", "int"), -5).when(base == "bigint", 3)
    return F.when(unsigned & wider.isNotNull(), wider).otherwise(F.element_at(codes, base))


def bits_to_int(raw: Column) -> Column:
    """Big-endian bytes, up to 64 bits, as an unsigned number."""
    return F.conv(F.hex(raw), 16, 10).cast("decimal(20,0)")


def _hex_xor(a: Column, b: Column) -> Column:
    """XOR of two binaries of one length, a multiple of 8 bytes."""
    word = lambda x, i: F.conv(F.substring(x, i * 16 + 1, F.lit(16)), 16, -10).cast("bigint")
    ha, hb = F.hex(a), F.hex(b)
    words = F.transform(F.sequence(F.lit(0), (F.length(a) / 8).cast("int") - 1), lambda i: F.lpad(F.hex(word(ha, i.cast("int")).bitwiseXOR(word(hb, i.cast("int")))), 16, "0"))
    return F.unhex(F.array_join(words, ""))


def _counter_cipher(data: Column, key: Column, iv: Column) -> Column:
    """AES in counter mode: block i of the key stream is the cipher of the
    16-byte start value plus i. The same step ciphers and deciphers."""
    blocks = F.greatest(F.lit(1), F.ceil(F.length(data) / F.lit(16))).cast("int")
    number = lambda x: F.conv(F.hex(x), 16, 10).cast("decimal(38,0)")
    low, high = number(F.substring(iv, 9, 8)), F.conv(F.hex(F.substring(iv, 1, 8)), 16, -10).cast("bigint")
    size = F.lit(Decimal(1 << 64))

    def stream(i: Column) -> Column:
        total = low + i.cast("decimal(20,0)")
        carry = total >= size  # goes to the upper half
        lower = F.conv(F.when(carry, total - size).otherwise(total).cast("string"), 10, 16)
        upper = F.hex(F.when(carry, high + 1).otherwise(high))
        block = F.unhex(F.concat(F.lpad(upper, 16, "0"), F.lpad(lower, 16, "0")))
        # padding adds a block of its own, which is cut off
        return F.hex(F.substring(F.aes_encrypt(block, key, F.lit("ECB"), F.lit("PKCS")), 1, 16))

    keys = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), blocks - 1), stream), ""))
    padded = F.unhex(F.rpad(F.hex(data), blocks * 32, F.lit("0")))
    return F.substring(_hex_xor(padded, keys), F.lit(1), F.length(data))


def encrypt(data: Column, key: Column, iv: Column, version: int, key_id: bytes) -> Column:
    """Frame of an encrypted payload: version, three bytes of key id, the 16-byte
    start value, AES-256-CTR text. Null stays null."""
    if version == 0 or len(key_id) != 3:
        raise ValueError("the version is not 0 and a key id has three bytes")
    return F.concat(F.lit(bytes([version]) + key_id), iv, _counter_cipher(data, key, iv))


def decrypt(frame: Column, key: Column) -> Column:
    """The payload of a frame; a frame of version 0 holds it as it is after its
    four bytes, and one that is too short gives null."""
    body = F.substring(frame, F.lit(5), F.length(frame))
    iv, text = F.substring(body, 1, 16), F.substring(body, F.lit(17), F.length(body))
    plain = F.hex(F.substring(frame, 1, 1)) == "00"
    return F.when(F.length(frame) < 4, None).when(plain, body).when(F.length(body) >= 16, _counter_cipher(text, key, iv))


NULL_TEXT = "\\N"


def csv_quote(v: Column, quote: str = '"') -> Column:
    return F.coalesce(F.concat(F.lit(quote), F.replace(v, F.lit(quote), F.lit(quote * 2)), F.lit(quote)), F.lit(NULL_TEXT))


def csv_escape(v: Column, delimiter: str = ",") -> Column:
    """Backslash form, for a CSV without quotes."""
    out = F.replace(v, F.lit("\\"), F.lit("\\\\"))
    for plain, code in (("\r", "\\r"), ("\n", "\\n"), (delimiter, "\\" + delimiter)):
        out = F.replace(out, F.lit(plain), F.lit(code))
    return F.coalesce(out, F.lit(NULL_TEXT))


def enum_name(index: Column, names: list[str]) -> Column:
    """Name of a 1-based index; 0 or one out of range gives an empty string."""
    arr = F.array(*map(F.lit, names))
    return F.when((index >= 1) & (index <= len(names)), F.get(arr, (index - 1).cast("int"))).otherwise("")


def set_names(mask: Column, names: list[str]) -> Column:
    picked = [F.when(mask.bitwiseAND(1 << i) != 0, F.lit(n)) for i, n in enumerate(names)]
    return F.concat_ws(",", *picked)


def date_path(ts: Column, unit: str) -> Column:
    return F.date_format(ts, {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}[unit])


def default_timestamp(utc: Column, zone: str) -> Column:
    """Text of a UTC default value in a session's time zone."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss")


def redact(v: Column, mode: str) -> Column:
    if mode == "off":
        return v
    return F.lit("?") if mode == "on" else F.concat(F.lit("<"), v, F.lit(">"))


def finite(v: Column) -> Column:
    """NaN and infinities become 0."""
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0)).otherwise(v)


def little_endian(v: Column) -> Column:
    """8 bytes of a bigint, lowest first."""
    hexed = F.lpad(F.hex(v), 16, "0")
    return F.unhex(F.concat(*[F.substring(hexed, i, 2) for i in range(15, 0, -2)]))


def row_checksum(columns: list[tuple[str, Column]]) -> Column:
    """CRC32 over the typed bytes of a row, columns in order: numbers as 8 bytes
    little-endian, texts with their length as 4 bytes before; nulls give none."""
    parts = []
    for kind, c in columns:
        if kind == "bigint":
            raw = little_endian(c)
        else:
            data = F.encode(c, "UTF-8")
            raw = F.concat(F.substring(little_endian(F.length(data).cast("bigint")), F.lit(1), F.lit(4)), data)
        parts.append(F.coalesce(raw, F.unhex(F.lit(""))))
    return F.crc32(F.concat(*parts))


def rewrite_ddl(query: Column, schema: Column, table: Column) -> Column:
    """Renames the table of CREATE, DROP, ALTER and TRUNCATE TABLE statements;
    other statements stay as they are."""
    head = r"(?i)^(\s*(?:create|drop|alter|truncate)\s+table\s+(?:if\s+(?:not\s+)?exists\s+)?)((?:`[^`]+`|\w+)(?:\.(?:`[^`]+`|\w+))?)"
    target = F.concat(quote_name(schema), F.lit("."), quote_name(table))
    start = F.regexp_extract(query, head, 1)
    rest = F.regexp_replace(query, F.lit(head), F.lit(""))
    return F.when(start == "", query).otherwise(F.concat(start, target, rest))


def index_usable(indexes: dict[str, bool], name: str) -> bool:
    """A partition index must exist and be unique."""
    return indexes.get(name, False)


def compress(codec: str):
    """Payload compression, in Arrow batches."""

    @pandas_udf("binary")
    def run(v: pd.Series) -> pd.Series:
        pack = _codec(codec)[0]
        return v.map(lambda b: None if b is None else pack(bytes(b)))

    return run


def decompress(codec: str):
    @pandas_udf("binary")
    def run(v: pd.Series) -> pd.Series:
        unpack = _codec(codec)[1]
        return v.map(lambda b: None if b is None else unpack(bytes(b)))

    return run


def _codec(name: str):
    if name == "zstd":
        import zstandard

        return zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
    if name in ("lz4", "snappy", "gzip"):
        import pyarrow as pa

        # the size goes before the data: these codecs need it to unpack
        pack = lambda b: len(b).to_bytes(8, "little") + pa.compress(b, name, asbytes=True)
        unpack = lambda b: pa.decompress(b[8:], int.from_bytes(b[:8], "little"), name, asbytes=True)
        return pack, unpack
    if name == "none":
        return bytes, bytes
    raise ValueError(f"unknown compression {name}")
