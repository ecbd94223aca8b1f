"""Secrets in whole texts.

An Aho-Corasick automaton over the keywords of all rules reads each text once (its A-Z
lower-cased, so that places stay the same); only where a keyword ends is the anchored
pattern of its rule tried. Rules whose secrets carry a checksum keep a hit only if the
checksum holds. Hex runs have no keyword: their hits are places where 24 hex digits stand
together, found by one pattern search.

Texts are read row by row inside tasks and never shuffled; a task holds one Arrow batch.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in the order in which ties at one start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem", "card")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ )?PRIVATE KEY)-----(?:[\x20\t]*\r?\n)?((?:[A-Za-z][A-Za-z0-9-]*:[^\n]*\n(?:[\x20\t][^\n]*\n)*)*)([A-Za-z0-9+/=\s]+)-----END \1-----")
CARD = re.compile(r"(?:card|visa|mastercard|amex)(?:\x20?(?:number|no\.?))?[\"']?\x20*[:=#]?\x20*[\"']?((?:[0-9][\x20-]?){12,18}[0-9])(?![0-9])", re.ASCII | re.IGNORECASE)

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(number: int, width: int) -> str:
    digits = ""
    while number:
        number, rest = divmod(number, 62)
        digits = BASE62[rest] + digits
    return digits.rjust(width, "0")


def crc_holds(match: re.Match) -> bool:
    """The last six characters are the base-62 CRC-32 of the thirty before them."""
    return base62(zlib.crc32(match[1].encode()), 6) == match[2]


def luhn_holds(match: re.Match) -> bool:
    digits = [int(c) for c in match[1] if c.isdigit()]
    doubled = [sum(divmod(2 * d, 10)) for d in digits[-2::-2]]
    return len(set(digits)) > 1 and (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def jwt_holds(match: re.Match) -> bool:
    """Header and claims are base64url of JSON objects and the header names an algorithm."""
    try:
        head, body = (json.loads(base64.urlsafe_b64decode(match[k] + "=" * (-len(match[k]) % 4))) for k in (1, 2))
    except (ValueError, binascii.Error):
        return False
    return isinstance(head, dict) and isinstance(body, dict) and "alg" in head


def pem_holds(match: re.Match) -> bool:
    """The body is base64 of a DER sequence, of an OpenSSH key, or of what its header says is encrypted."""
    try:
        body = base64.b64decode("".join(match[3].split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if "ENCRYPTED" in match[2]:
        return len(body) >= 8
    return body.startswith(b"openssh-key-v1\0") if match[1].startswith("OPENSSH ") else body[:1] == b"\x30"


def long_value(match: re.Match) -> bool:
    return len(match[2]) >= 6


def long_key(match: re.Match) -> bool:
    return len(match[0]) >= 20


#: kind -> lower-case keywords, anchored pattern, the test that keeps a match.
RULES = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), ASSIGN, long_value),
    "access": (("akia",), ACCESS, long_key),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), GITHUB, crc_holds),
    "npm": (("npm_",), NPM, crc_holds),
    "jwt": (("eyj",), JWT, jwt_holds),
    "pem": (("-----begin ",), PEM, pem_holds),
    "card": (("card", "visa", "mastercard", "amex"), CARD, luhn_holds),
}


def build_automaton() -> ahocorasick.Automaton:
    words: dict[str, list[tuple[str, int]]] = {}
    for kind, (keywords, _, _) in RULES.items():
        for word in keywords:
            words.setdefault(word, []).append((kind, len(word)))
    automaton = ahocorasick.Automaton()
    for word, owners in words.items():
        automaton.add_word(word, tuple(owners))
    automaton.make_automaton()
    return automaton


def find_secrets(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets, by start, then kind as listed.

    Within a kind matches are leftmost and don't overlap; a match that fails its test is
    dropped, but still takes its room, as in a search from left to right."""
    starts: dict[str, list[int]] = {}
    for last, owners in automaton.iter(text.encode().lower().decode()):
        for kind, size in owners:
            starts.setdefault(kind, []).append(last - size + 1)
    found = [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    for kind, places in starts.items():
        _, pattern, holds = RULES[kind]
        free = 0
        for start in sorted(places):
            if start >= free and (match := pattern.match(text, start)):
                free = match.end()
                if holds(match):
                    found.append((start, kind, free))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``secrets`` (array of kind, start, end, value) of every row.

    Null and empty texts have an empty array; repeated rows are scanned each; other columns
    are left out, so clashing names do no harm; an empty table gives no rows."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                rows.append([{"kind": k, "start": a, "end": b, "value": text[a:b]} for a, k, b in find_secrets(text, automaton)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "secrets"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(scanned, "doc_id long, secrets array<struct<kind:string,start:long,end:long,value:string>>")


def redact_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret of ``text`` replaced by ``mask``; overlapping ones become one.

    Null texts stay null. All columns of ``docs`` and their order stay."""
    schema = docs.schema
    at = schema.fieldNames().index("text")

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton()
        for batch in batches:
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                if text:
                    parts, done = [], 0
                    for start, end in joined([(a, b) for a, _, b in find_secrets(text, automaton)]):
                        parts += [text[done:start], mask]
                        done = end
                    text = "".join([*parts, text[done:]])
                texts.append(text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(redacted, schema)


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans made one; the spans come by start."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined_spans = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *(of(kind) for kind in BASE_KINDS),
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("secrets")).alias("spans"),
    )

