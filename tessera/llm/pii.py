"""Personal data: an Aho-Corasick pass finds anchors, local parsers expand each to its span and validate it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SPANS = "array<struct<kind: string, start: int, end: int>>"

#: Characters and patterns of the contract, and the words that announce an identifier.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "iban", "ssn", "passport", "token", "secret", "api_key", "apikey", "password")
URL_REST = re.compile(r"(?:[A-Za-z0-9._%+:~-]+@)?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?(?:[/?#][^\s<>\"'|]*)?")
BEFORE_ACCOUNT = re.compile(r"(?:[ ](?:no\.?|number|id|key))?[ ]?[:=#]?[ ]?[\"']?", re.I)
ACCOUNT = re.compile(r"[A-Za-z0-9][A-Za-z0-9_./+=-]*(?:[ ](?=[A-Za-z-]*[0-9])[A-Za-z0-9-]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


@cache
def anchors():
    """An automaton over texts in lower case whose values are (what was found, length)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for d in DIGITS:
        found.add_word(d, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    for s in SCHEMES:
        found.add_word(s, ("scheme", len(s)))
    for c in CUES:
        found.add_word(c, ("cue", len(c)))
    found.make_automaton()
    return found


def folded(text: str) -> str:
    """A-Z in lower case; every other code point stays, so places do as well."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def account(text: str, at: int) -> tuple[int, int, bool]:
    """Start and end of the identifier after a cue that ends at ``at``, and whether it is one.

    It is a run of letters, digits and the signs that keys use, of any length; parts that follow after a single
    blank belong to it while they hold a digit. Eight letters or digits and four digits make it valid.
    """
    start = BEFORE_ACCOUNT.match(text, at).end()
    if not (m := ACCOUNT.match(text, start)):
        return start, start, False
    value = m[0].rstrip("._/+-")
    return start, start + len(value), sum(map(str.isalnum, value)) >= 8 and sum(c in DIGITS for c in value) >= 4


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as KINDS lists them and then by start.

    Within a kind spans never overlap and the leftmost wins. What fails its validation is dropped but has
    used up its characters, as in a search for the pattern.
    """
    out: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)

    def keep(kind: str, start: int, end: int, valid: bool) -> None:
        done[kind] = end
        if valid:
            out[kind].append((kind, start, end))

    for last, (what, size) in anchors().iter(folded(text)):
        at = last - size + 1
        if what == "digit":
            if at and text[at - 1] in DIGITS:
                continue
            if at >= done["ip"] and (m := IP.match(text, at)):
                parts = [p.lstrip("0") for p in m[0].split(".")]
                keep("ip", at, m.end(), all(len(p) < 4 and int(p or 0) <= 255 for p in parts))
            if at >= done["card"] and (m := CARD.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                keep("card", at, m.end(), 13 <= len(digits) <= 19 and luhn(digits))
        elif what == "at":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at)):
                keep("email", start, m.end(), True)
        elif what == "plus":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                keep("phone", at, m.end(), 9 <= sum(c in DIGITS for c in m[0]) <= 15)
        elif what == "scheme":
            if at >= done["url"] and not (at and text[at - 1].isalnum()) and (m := URL_REST.match(text, last + 1)):
                keep("url", at, last + 1 + len(m[0].rstrip(".,;:!?)]}")), True)
        elif at >= done["account"] and not (at and text[at - 1].isalnum()):
            start, end, valid = account(text, last + 1)
            if end > start:
                keep("account", start, end, valid)
    return [s for k in KINDS for s in out[k]]


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for each row: every span of personal data in the whole text, in code points.

    Base kinds are email, ip, card and phone; url and account come from schemes and cue words. Null and empty
    texts have no spans. Repeated rows stay; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t)] if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kind))], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, spans {SPANS}")


def spelled(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in angle brackets; overlapping spans become one.

    Null texts stay null and empty ones empty. Repeated rows stay; other columns are left out; an empty table
    gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                parts, at = [], 0
                for kind, start, end in sorted(spans(text or ""), key=lambda s: (s[1], -s[2])):
                    if start >= at:
                        parts += [text[at:start], f"<{kind}>"]
                    at = max(at, end)
                out.append(None if text is None else "".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string")
