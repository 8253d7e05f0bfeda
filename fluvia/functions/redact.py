"""Credentials out of texts, by regular expressions within Spark's expressions.

``redacted`` masks what has the shape of a credential and leaves the rest as it is;
``scrubbed`` is for messages: it also cuts addresses down to what is harmless, masks
long runs of token characters, and cuts the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a secret's name, and the mask (plain, and as a query value).
NAMES = (
    "(?:access|refresh|id|bearer|session|sas)?[_-]?token|secret|password|passwd|pwd|api[_-]?key|apikey|client[_-]?secret|private[_-]?key"
    "|credential|assertion|authorization|auth|tempauth|signature|sig|passphrase|connection[_-]?string|dsn"
)
MASK, QUERY_MASK = "***", "%2A%2A%2A"

# Query parameters whose values stay.
SAFE = (
    "alt", "api-version", "count", "end", "end_date", "expand", "fields", "filter", "format", "limit", "maxresults", "offset", "order", "order_by", "orderby",
    "page", "page_size", "pagesize", "per_page", "q", "query", "select", "since", "skip", "sort", "start", "start_date", "top", "until", "version",
)

# The shapes of web tokens, authorization schemes, addresses, the marks that may end a sentence behind one, and of tokens without a name.
TOKEN = r"\beyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]*"
SCHEME = r"(?i)\b(Bearer|Basic|Token|ApiKey)\s+[A-Za-z0-9._~+/=\-]+"
ADDRESS = r"[a-zA-Z][a-zA-Z0-9+.\-]*://[^\s\"'<>`\\|]+"
BEHIND = r"[.,;:)\]}>'\"]+$"
RUN = r"\b(?=[A-Za-z0-9_\-]*[0-9])[A-Za-z0-9_\-]{32,}\b"
# A name and what parts it from its value, a quoted value of several words, and any other value.
PAIR = rf"(?i)(['\"]?\b(?:{NAMES})\b['\"]?[ \t]*[=:][ \t]*)"
QUOTED, BARE = r"(?:\"[^\"\n]*[ \t][^\"\n]*\"|'[^'\n]*[ \t][^'\n]*')", r"(['\"]?)([^\s,;&)\]}'\"]+)\2"

#: Something of each name, and of each scheme with the blank behind it: texts without them need no other pattern.
_HINT = r"(?i)token|secret|passw|pwd|key|credential|assertion|auth|sig|passphrase|connection|dsn"
_SCHEME_HINT = r"(?i)(?:bearer|basic|token|apikey)\s"

#: Characters of a scrubbed message at most.
MOST = 4096


def redacted(text: Column) -> Column:
    """JSON web tokens, authorization schemes and values behind a secret's name become the mask; names may be quoted, and so may values.

    A quoted value of several words is masked with its quotes.
    """
    tokens = F.contains(text, F.lit("eyJ")) | text.rlike(_SCHEME_HINT)
    pairs = (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & text.rlike(_HINT)
    out = F.when(tokens, F.regexp_replace(F.regexp_replace(text, TOKEN, MASK), SCHEME, f"$1 {MASK}")).otherwise(text)
    # A mask never makes a name or a value of what stands around it, so the hints of the text hold.
    return F.when(pairs, F.regexp_replace(F.regexp_replace(out, PAIR + QUOTED, f"$1{MASK}"), PAIR + BARE, f"$1$2{MASK}$2")).otherwise(out)


def scrubbed_url(url: Column) -> Column:
    """User info goes; query values stay for harmless names only; a fragment is masked.  Marks at the end, which close a sentence, stay."""
    behind = F.regexp_extract(url, BEHIND, 0)
    bare = F.regexp_replace(url, BEHIND, "")
    whole = F.substring_index(bare, "#", 1)
    head = F.regexp_replace(F.substring_index(whole, "?", 1), r"^([^/]*//)[^/]*@", "$1")
    query = F.when(F.contains(whole, F.lit("?")), F.call_function("substring", whole, F.length(F.substring_index(whole, "?", 1)) + 2)).otherwise("")
    pieces = F.filter(F.split(query, "&"), lambda p: p != "")

    def piece(p: Column) -> Column:
        name = F.substring_index(p, "=", 1)
        return F.when(F.lower(name).isin(*SAFE), F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("=")))).otherwise(F.concat(name, F.lit("=" + QUERY_MASK)))

    query = F.when(F.size(pieces) > 0, F.concat(F.lit("?"), F.array_join(F.transform(pieces, piece), "&"))).otherwise("")
    fragment = F.when(F.length(bare) > F.length(whole) + 1, F.lit("#" + MASK)).otherwise("")
    return F.concat(head, query, fragment, behind)


def scrubbed(text: Column, most: int = MOST) -> Column:
    """A message without credentials: addresses scrubbed, the shapes of ``redacted`` and long token-like runs masked, cut to ``most`` characters."""
    addresses = F.transform(F.regexp_extract_all(text, F.lit(ADDRESS), F.lit(0)), scrubbed_url)
    between = F.split(text, ADDRESS, -1)
    out = F.array_join(F.flatten(F.transform(between, lambda part, i: F.array(part, F.coalesce(F.get(addresses, i), F.lit(""))))), "")
    out = F.regexp_replace(redacted(out), RUN, MASK)
    suffix = F.concat(F.lit("… [truncated, "), F.length(out).cast("string"), F.lit(" chars]"))
    return F.when(F.length(out) <= most, out).otherwise(F.concat(F.call_function("substring", out, F.lit(1), F.greatest(F.lit(0), F.lit(most) - F.length(suffix))), suffix))
