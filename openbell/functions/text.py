"""Article text assembly, content keys and parsing of stored model responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (Spark's trim alone
# removes spaces only). Trimming by a character set looks at the ends of a text;
# a regex would walk all of it.
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
JSON_FRAGMENT = r"\{[^{}]+\}"


def strip(c) -> Column:
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITESPACE))


def news_text(title="title", description="description") -> Column:
    """``title. description`` with one period where the title already has one."""
    title = F.col(title) if isinstance(title, str) else title
    description = F.col(description) if isinstance(description, str) else description
    joined = F.concat(strip(title), F.lit(". "), strip(description))
    return F.replace(joined, F.lit(".. "), F.lit(". "))


def content_key(text) -> Column:
    """The SHA-256 of the whole text, in hex: the identity of a text. Shorter
    prefixes may be shown, never grouped or joined on."""
    return F.sha2(text, 256)


def display_key(text_hash) -> Column:
    """The first 16 hex digits, for people."""
    return F.substring(text_hash, 1, 16)


def class_probability(labels, name: str) -> Column:
    """Score of one class in an array<struct<label, score>>; missing gives 0.

    The last entry wins if a label repeats, whatever its case.
    """
    labels = F.col(labels) if isinstance(labels, str) else labels
    matching = F.filter(labels, lambda e: F.lower(e["label"]) == name)
    return F.coalesce(F.try_element_at(matching, F.lit(-1))["score"], F.lit(0.0))


def response_map(raw) -> Column:
    """Model reply -> map<string,string>: the whole reply as JSON, else its
    first ``{...}`` fragment, else NULL."""
    whole = F.from_json(raw, "map<string,string>")
    fragment = F.from_json(F.regexp_extract(raw, JSON_FRAGMENT, 0), "map<string,string>")
    return F.coalesce(whole, fragment)


def response_field(parsed, name: str, prefix: str) -> Column:
    """Exact key, else the first key with the prefix; not a number gives NULL."""
    parsed = F.col(parsed) if isinstance(parsed, str) else parsed
    near = F.filter(F.map_keys(parsed), lambda k: k.startswith(prefix))
    key = F.when(F.map_contains_key(parsed, name), F.lit(name)).otherwise(
        F.try_element_at(near, F.lit(1))
    )
    return F.try_element_at(parsed, key).try_cast("double")


def tier2_scores(raw) -> Column:
    """struct<relevance, novelty, subjectivity>, or NULL unless all three exist."""
    parsed = response_map(raw)
    fields = {
        "relevance": response_field(parsed, "relevance", "rel"),
        "novelty": response_field(parsed, "novelty", "nov"),
        "subjectivity": response_field(parsed, "subjectivity", "sub"),
    }
    complete = F.lit(True)
    for c in fields.values():
        complete = complete & c.isNotNull()
    return F.when(complete, F.struct(*[c.alias(n) for n, c in fields.items()]))
