"""Key texts, record images, code picks and reproducible draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: record images keep microseconds.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def key_text(columns: Sequence[str], record: str | None = None) -> Column:
    """``col=value;`` for every key column in the given order; a missing value reads ``NULL``."""
    parts = []
    for name in columns:
        value = F.col(f"{record}.{name}" if record else name).cast("string")
        parts += [F.lit(f"{name}="), F.coalesce(value, F.lit("NULL")), F.lit(";")]
    return F.concat(*parts)


def record_image(record: Column) -> Column:
    """JSON text of a struct with null fields kept and timestamps in full precision."""
    return F.to_json(record, {
        "ignoreNullFields": "false",
        "timestampNTZFormat": TIMESTAMP_FORMAT,
        "timestampFormat": TIMESTAMP_FORMAT,
    })


def pick(values: Sequence[str], position: Column) -> Column:
    """The element at a 1-based position of a literal list; null outside the list."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def padded_code(prefix: str, number: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def uniform(seed: int, *key: Column) -> Column:
    """A reproducible draw in [0, 1) per key.

    It depends on the key only, not on partitioning, so a task that runs again
    on another executor draws the same values.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def skewed_draw(u: Column, size: Column, exponent: float = 2.5) -> Column:
    """A foreign key in 1..size that favours small keys, from a uniform ``u``."""
    return (F.lit(1) + F.floor(F.pow(u, F.lit(exponent)) * size)).cast("int")


def elapsed_ms(start: Column, end: Column) -> Column:
    """Milliseconds between two timestamps; without zone, the session's time zone plays no part."""
    passed = end - start

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), passed)

    seconds = ((part("DAY") * 24 + part("HOUR")) * 60 + part("MINUTE")) * 60 + part("SECOND")
    return (seconds * 1000).cast("double")
