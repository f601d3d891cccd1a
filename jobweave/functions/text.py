"""Text expressions shared by the operators. All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# The characters that count as white space at the ends of a text.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column | str) -> Column:
    """Remove white space of any kind (also tabs, line ends, Unicode spaces) at both ends."""
    return F.btrim(_col(value), F.lit(WHITE_SPACE))


def is_blank(value: Column | str) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(strip(value) == "", F.lit(True))


def or_default(value: Column | str, default: Column | str) -> Column:
    """`value` unless null or empty; a plain string default is a literal."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(_col(value), F.lit("")), fallback)


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty after stripping, else ''."""
    return F.coalesce(*[F.nullif(strip(v), F.lit("")) for v in values], F.lit(""))


def cut(value: Column | str, length: int) -> Column:
    return F.substring(_col(value), 1, length)


def composite_key(*parts: Column | str) -> Column:
    """Display key `a|b`. Joins use the parts themselves."""
    return F.concat_ws("|", *[_col(p) for p in parts])


def iso_timestamp(value: Column | str, run_at: Column | None = None) -> Column:
    """ISO-8601 text without zone; fractional seconds only where present; null becomes `run_at`."""
    ts = _col(value)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
    return text if run_at is None else F.coalesce(text, run_at)


def source_label(label: Column | str, source_id: Column | str) -> Column:
    """Registered short label, else the id in upper case."""
    return F.coalesce(_col(label), F.upper(_col(source_id)))


def short_display_name(display_name: Column | str) -> Column:
    """Display name without parenthesised parts."""
    return strip(F.regexp_replace(_col(display_name), r"\s*\(.*?\)\s*", ""))


def duration_text(seconds: Column | str) -> Column:
    """'—' for null, '12.5 s' below a minute, else '3 m 07 s'."""
    s = _col(seconds)
    minutes = F.floor(s / 60).cast("string")
    rest = F.lpad(F.floor(s % 60).cast("string"), 2, "0")
    return (
        F.when(s.isNull(), F.lit("—"))
        .when(s < 60, F.concat(F.call_function("format_number", s, F.lit("0.0")), F.lit(" s")))
        .otherwise(F.concat(minutes, F.lit(" m "), rest, F.lit(" s")))
    )


def plural(count: Column, singular: str, suffix: str) -> Column:
    return F.when(count == 1, F.lit(singular)).otherwise(F.lit(singular + suffix))


def absolute_url(href: Column, base_url: Column | str) -> Column:
    """`href` made absolute; '' when there is none."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    joined = F.concat(base, F.lit("/"), F.regexp_replace(href, "^/+", ""))
    return F.when(F.coalesce(href, F.lit("")) == "", F.lit("")).otherwise(
        F.when(href.startswith("http"), href).otherwise(joined)
    )


def href_of(fragment: Column | str) -> Column:
    """Target of the first href in an HTML fragment that may still carry JSON escapes."""
    plain = _col(fragment)
    for escaped, char in (("\\u003d", "="), ("\\u0026", "&"), ('\\"', '"'), ("\\/", "/")):
        plain = F.replace(plain, F.lit(escaped), F.lit(char))
    return F.regexp_extract(plain, r"""href\s*=\s*["']([^"'>]+)""", 1)
