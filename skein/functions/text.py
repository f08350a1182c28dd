"""Text, dates, authors and sizes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_MARKERS = ("unusual traffic", "slow down", "rate limit", "too many requests", "automated requests", "access denied", "been blocked")
_SUFFIXES = ("Jr", "Jr.", "Sr", "Sr.", "II", "III", "IV")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def rfc2822_date(text: Column) -> Column:
    """The date as written, without a shift of zone; null if it can't be read."""
    return F.to_date(F.try_to_timestamp(F.regexp_extract(text, r"(\d{1,2} \w{3} \d{4})", 1), F.lit("d MMM yyyy")))


def to_rfc2822(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))


def author_names(parsed: Column) -> Column:
    """'Last, First Suffix' for each [last, first, suffix]; empty names go."""

    def one(p: Column) -> Column:
        part = lambda i: F.trim(F.coalesce(F.get(p, F.lit(i)), F.lit("")))
        name = F.concat_ws(", ", F.nullif(part(0), F.lit("")), F.nullif(part(1), F.lit("")))
        return F.trim(F.concat_ws(" ", name, F.nullif(part(2), F.lit(""))))

    return F.filter(F.transform(F.coalesce(parsed, F.array().cast("array<array<string>>")), one), lambda n: n != "")


def split_authors(raw: Column) -> Column:
    """[last, first, suffix] for each author of a free-text list; parentheses go, 'and' separates.

    Nested parentheses are taken off from the inside, as many times as there are opening ones.
    """
    levels = F.length(raw) - F.length(F.replace(raw, F.lit("("), F.lit("")))
    flat = F.when(levels == 0, raw).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(levels, F.lit(1))), raw, lambda t, _: F.regexp_replace(t, r"\([^()]*\)", " ")))
    flat = F.regexp_replace(flat, r",?\s+and\s+", ", ")
    names = F.filter(F.transform(F.split(flat, r"[,;]"), collapse_spaces), lambda n: n != "")

    def one(name: Column) -> Column:
        words = F.split(name, " ")
        suffix = F.when((F.size(words) > 1) & F.element_at(words, -1).isin(*_SUFFIXES), F.element_at(words, -1)).otherwise("")
        kept = F.when(suffix != "", F.slice(words, F.lit(1), F.size(words) - 1)).otherwise(words)
        return F.array(F.element_at(kept, -1), F.array_join(F.slice(kept, F.lit(1), F.size(kept) - 1), " "), suffix)

    return F.transform(names, one)


def split_categories(text: Column) -> Column:
    return F.filter(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+"), lambda c: c != "")


def author_list(text: Column) -> Column:
    """Names from JSON text; anything that isn't a list gives an empty one."""
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def width_bucket(value: Column, width: int) -> Column:
    return (F.floor(value / width) * width).cast("long")


def human_size(n: Column) -> Column:
    """1.5 KB and the like, by powers of 1024."""
    units, out = "B KB MB GB TB".split(), None
    for k, unit in enumerate(units):
        shown = F.format_string("%,.1f " + unit, n.cast("double") / F.lit(float(1024**k)))
        if out is None:
            out = F.when(n < 1024, shown)
        elif k < len(units) - 1:
            out = out.when(n < 1024 ** (k + 1), shown)
        else:
            out = out.otherwise(shown)
    return out


def human_duration(seconds: Column) -> Column:
    """9s, 1m30s, 1m, 1h30m"""
    s = F.greatest(F.lit(0), F.bround(seconds)).cast("long")
    minutes, rest = F.floor(s / 60), F.pmod(s, F.lit(60))
    short = F.when(rest > 0, F.format_string("%dm%02ds", minutes, rest)).otherwise(F.format_string("%dm", minutes))
    return F.when(s < 60, F.format_string("%ds", s)).when(s < 3600, short).otherwise(F.format_string("%dh%02dm", F.floor(s / 3600), F.pmod(minutes, F.lit(60))))


def backoff_seconds(attempt: Column, base: float = 1.0, cap: float = 60.0) -> Column:
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt))


def looks_blocked(body: Column) -> Column:
    """Do the first 2,048 bytes of a binary page show one of the markers of a refusal?"""
    head = F.lower(F.decode(F.substring(body, 1, 2048), "ISO-8859-1"))
    return head.rlike("|".join(BLOCK_MARKERS))


def is_pdf(content: Column) -> Column:
    return F.coalesce(F.substring(content, 1, 5) == F.lit(b"%PDF-"), F.lit(False))


_PLAIN_YAML = r"^[A-Za-z][A-Za-z0-9_]*([ .,/-]+[A-Za-z0-9_]+)*$"
_WORDS_OF_YAML = ("true", "false", "null", "yes", "no", "on", "off", "y", "n")


def yaml_scalar(value: Column) -> Column:
    """A text as a YAML scalar: plain where it can't be read as anything else, in double quotes with escapes elsewhere."""
    plain = value.rlike(_PLAIN_YAML) & ~F.lower(value).isin(*_WORDS_OF_YAML)
    quoted = value
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\t", "\\t"), ("\r", "\\r")):
        quoted = F.replace(quoted, F.lit(a), F.lit(b))
    return F.when(plain, value).otherwise(F.concat(F.lit('"'), quoted, F.lit('"')))


def front_matter(texts: dict[str, Column], numbers: dict[str, Column] | None = None, lists: dict[str, Column] | None = None) -> Column:
    """The YAML head of a Markdown file; nulls, empty texts and empty lists are left out, the order is kept."""
    parts = [F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{k}: "), yaml_scalar(c), F.lit("\n"))) for k, c in texts.items()]
    parts += [F.concat(F.lit(f"{k}: "), c.cast("string"), F.lit("\n")) for k, c in (numbers or {}).items()]
    parts += [F.when(F.size(c) > 0, F.concat(F.lit(f"{k}:\n"), F.array_join(F.transform(c, lambda x: F.concat(F.lit("- "), yaml_scalar(x), F.lit("\n"))), ""))) for k, c in (lists or {}).items()]
    return F.concat(F.lit("---\n"), F.concat_ws("", *parts), F.lit("---\n\n"))


def memory_floor(setting: str | float | None, total: int) -> int | None:
    """Bytes of a memory floor: '4GB' and the like, a share of the total below 1, or bytes; nothing, zero or 'off' is none."""
    if setting is None or str(setting).strip().lower() in ("", "off", "none", "0"):
        return None
    found = re.fullmatch(r"\s*([0-9.]+)\s*([kmgt]?)i?b?\s*", str(setting).lower())
    if not found:
        raise ValueError(f"can't read the memory floor {setting!r}")
    n, unit = float(found[1]), found[2]
    if n <= 0:
        return None
    return int(n * 1024 ** " kmgt".index(unit)) if unit else int(n * total) if n < 1 else int(n)


def converter_in_front_matter(head: Column) -> Column:
    """The converter named in the front matter at the head of a Markdown file, or null."""
    block = F.substring_index(head, "\n---", 1)
    name = F.regexp_extract(block, r"""(?m)^converter:\s*['"]?([\w.\-]+)""", 1)
    return F.when(head.startswith("---"), F.nullif(name, F.lit("")))


def fallback_in_line(line: Column) -> Column:
    """struct<id, converter> of a log line that reports a conversion by fallback; nulls for other lines."""
    pattern = r"(\S+) converted by fallback (\S+) after"
    return F.struct(F.nullif(F.regexp_extract(line, pattern, 1), F.lit("")).alias("id"), F.nullif(F.regexp_extract(line, pattern, 2), F.lit("")).alias("converter"))


def clip_errors(errors: Column, budget: int = 200) -> Column:
    """Messages of an error chain, each within its share of the budget, joined."""
    n = F.greatest(F.size(errors), F.lit(1))
    return F.array_join(F.transform(errors, lambda e: F.substr(e, F.lit(1), F.floor(F.lit(budget) / n).cast("int"))), "; ")


def has_all(have: Column, want: list[str]) -> Column:
    """Array containment."""
    return F.size(F.array_except(F.array(*map(F.lit, want)), have)) == 0


def title_matches(title: Column, words: str) -> Column:
    """Do all words of a query stand in the title? Lower case, letters and digits; no stemming."""
    wanted = sorted({w.lower() for w in words.split()})
    tokens = F.split(F.lower(title), r"[^\p{L}\p{N}]+")
    return has_all(tokens, wanted)


def date_floor(day: Column, overlap_days: int) -> Column:
    return F.date_sub(F.to_date(F.substring(day.cast("string"), 1, 10)), overlap_days)


def in_window(day: Column, low: str | None, high: str | None) -> Column:
    """Inclusive YYYY-MM window on an ISO date; a null date fails if a bound is set."""
    month = F.substring(day.cast("string"), 1, 7)
    if not low and not high:
        return F.lit(True)
    ok = F.lit(True)
    if low:
        ok = ok & (month >= low)
    if high:
        ok = ok & (month <= high)
    return F.coalesce(ok, F.lit(False))
