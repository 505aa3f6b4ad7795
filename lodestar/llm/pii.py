"""Personal data: anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, plus signs, digits,
schemes, identifier cues) in one pass over a text. Each anchor calls a local
parser that expands to the left and right of it and validates what it found.

Base kinds (leftmost, non-overlapping per kind, failing matches dropped):
``email``, ``ip``, ``card`` (16-19 digits passing Luhn), ``phone`` (8-15
digits). The method adds ``userinfo`` (credentials inside a URL), ``iban``
(checksum valid) and ``account`` (an identifier of six or more digits after a
cue word such as "account" or "passport").

Rows map one to one, nothing is shuffled. Null and empty texts give no spans;
repeated rows give repeated results; only the id and text columns are read,
so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import lean

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "userinfo", "iban", "account")
CUES = ("account", "acct", "iban", "passport", "ssn", "routing", "licence no", "license no", "tax id")
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()),
                                 T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType())]))

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]++")
_IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]+:[^\s/?#@:]+@(?=[A-Za-z0-9\[])")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?: (?:number|no|nr|id))?\.?[ ]?[:#=]?[ ]?((?:[A-Z]{1,2})?[0-9](?:[ -]?[0-9]){5,17})(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octet(part: str) -> bool:
    s = part.lstrip("0")
    return len(s) < 3 or len(s) == 3 and s <= "255"


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for cue in CUES:
        for form in {cue, cue.title(), cue.upper(), cue.capitalize()}:
            a.add_word(form, ("iban" if cue == "iban" else "cue", len(form)))
    a.make_automaton()
    return a


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans of one text as (kind, start, end), code points, end exclusive,
    ordered by kind (as in ``KINDS``) and start."""
    out: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    email_from = ip_from = card_from = 0
    n = len(text)
    for last, (what, length) in automaton.iter(text):
        i = last - length + 1
        if what == "digit":
            if i >= ip_from:
                m = _IP.match(text, i)
                if m:
                    if all(map(_octet, m[0].split("."))):
                        out["ip"].append(("ip", i, m.end()))
                    ip_from = m.end()
                else:  # every start in this run of digits fails alike
                    ip_from = _DIGITS.match(text, i).end()
            if i >= card_from:
                m = _CARD.match(text, i)
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        out["card"].append(("card", i, m.end()))
                    card_from = m.end()
                else:
                    card_from = i + 1
        elif what == "at":
            s = i
            while s > email_from and text[s - 1] in _LOCAL:
                s -= 1
            if s < i and (m := _DOMAIN.match(text, i + 1)):
                out["email"].append(("email", s, m.end()))
                email_from = m.end()
        elif what == "plus":
            m = _PHONE.match(text, i)
            if m and 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out["phone"].append(("phone", i, m.end()))
        elif what == "scheme":
            if m := _USERINFO.match(text, i + 3):
                out["userinfo"].append(("userinfo", i + 3, m.end() - 1))
        elif i == 0 or not text[i - 1].isalnum():
            if what == "iban":
                at = last + 1
                while at < n and at < last + 4 and text[at] in " :#=":
                    at += 1
                m = _IBAN.match(text, at)
                if m and _iban_ok(m[0]):
                    out["iban"].append(("iban", at, m.end()))
            elif m := _ACCOUNT.match(text, last + 1):
                out["account"].append(("account", m.start(1), m.end(1)))
    return [s for k in KINDS for s in out[k]]


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)``: one row per input row, spans as ``SPAN``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType), T.StructField("spans", SPAN)])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for b in batches:
            texts = b.column("text")
            spans = []
            for t in texts:
                found = find_spans(t.as_py() or "", automaton)
                spans.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(spans, span)], names=[id_col, "spans"])

    return src.mapInArrow(lean(run), schema)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by ``<kind>``.

    Overlapping spans become one, named after the first. A null text stays
    null. All columns are kept; ``n_chars``, where there is one, is renewed.
    """
    out_schema = docs.schema
    names = docs.columns
    at = names.index(text_col)
    counts = names.index("n_chars") if "n_chars" in names else None

    def clean(text: str, automaton) -> str:
        spans = sorted(find_spans(text, automaton), key=lambda s: (s[1], -s[2]))
        parts, pos = [], 0
        for kind, s, e in spans:
            if s >= pos:
                parts += [text[pos:s], f"<{kind}>"]
            pos = max(pos, e)
        return "".join(parts) + text[pos:] if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for b in batches:
            cols = list(b.columns)
            texts = [None if (t := x.as_py()) is None else clean(t, automaton) for x in cols[at]]
            cols[at] = pa.array(texts, cols[at].type)
            if counts is not None:
                cols[counts] = pa.array([None if t is None else len(t) for t in texts], cols[counts].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(lean(run), out_schema)
