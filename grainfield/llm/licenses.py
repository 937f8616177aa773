"""Licence scans: an Aho-Corasick automaton over words finds notice phrases and identifier tags, and a shunting-yard
parser evaluates the and/or/with expressions that follow a tag.

Words are runs of ASCII letters (A-Z lower-cased), digits and non-ASCII characters; a phrase is found wherever its
words stand consecutively, whatever stands between them. The expression of a tag is the longest well-formed one right behind it,
up to the end of the line or the next tag; what can't be an identifier ends it, as do marks at the end of a word.

Cases: null and empty texts have no words, no labels and score 0; labels are joined by commas, distinct and sorted; repeated phrases count
at each place; null ids and repeated rows are scanned like any, and equal rows get equal results; an empty table gives no rows; other
columns are ignored, whatever their names. Whole texts of any length are scanned, in time that follows their length.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# The phrases of the contract, further notices, and what the identifiers of expressions permit.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
MORE_PHRASES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc-by",
    "all rights reserved": "proprietary",
    "public domain": "public-domain",
}
TAG = "spdx license identifier"
PERMISSIVE = ("0bsd", "apache", "bsd", "cc-by", "cc0", "isc", "mit", "public-domain", "unlicense", "zlib")
RESTRICTED = ("cc-by-nc", "cc-by-nd", "cc-by-sa")
FAMILIES = frozenset(
    "0bsd afl agpl apache artistic beerware blessing bsd bsl bzip2 cc cc0 cddl cecill cpl curl epl eupl ftl gfdl gpl ijg intel ipl isc lgpl libpng lppl mit mpl ms mulanpsl ncsa "
    "nist odbl ofl openldap openssl osl php postgresql psf python qpl ruby sleepycat tcl ucl unicode unlicense upl vim w3c wtfpl x11 zlib zpl".split()
)
WEIGHTS = {"tag": 0.9, "base": 0.7, "more": 0.4}

WORD_BYTES = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
TAG_START = re.compile(rb"(?<![a-z0-9\x80-\xff])spdx[^a-z0-9\x80-\xff]+license[^a-z0-9\x80-\xff]+identifier(?![a-z0-9\x80-\xff])[ \t]*:?")
LINE_END = re.compile(rb"[\n\r]")
SYMBOL = re.compile(rb"[ \t]*(?:([()])|([a-z0-9][a-z0-9.+:-]*))")
BINDS = {"or": 1, "and": 2, "with": 3}


def automaton(phrases: dict[str, str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in phrases.items():
        found.add_word(f" {phrase} ", (len(phrase) + 1, label, "base" if phrase in BASE_PHRASES else "tag" if phrase == TAG else "more"))
    found.make_automaton()
    return found


def to_postfix(symbols: list[str]) -> list[str]:
    """Shunting-yard: postfix order of the longest well-formed expression that the symbols begin with ([] if none)."""
    out: list[str] = []
    stack: list[str] = []
    operand_next, good, depth = True, [], 0

    def drained() -> list[str]:
        return out + [s for s in reversed(stack) if s != "("]

    for symbol in symbols:
        if symbol == "(":
            if not operand_next:
                break
            stack.append(symbol)
            depth += 1
        elif symbol == ")":
            if operand_next or not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif symbol in BINDS:
            if operand_next:
                break
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[symbol]:
                out.append(stack.pop())
            stack.append(symbol)
            operand_next = True
            continue
        else:
            if not operand_next:
                break
            out.append(symbol)
            operand_next = False
        if not depth and not operand_next:
            good = drained()
    return good


def is_identifier(symbol: str) -> bool:
    """Whether a symbol can name a licence or an exception: of a known family, a reference of its own, or with a version behind a hyphen."""
    return symbol.split("-")[0].rstrip("+") in FAMILIES or symbol.startswith(("licenseref-", "documentref-")) or symbol.endswith("-exception") or re.search(r"-v?\d", symbol) is not None


def expressions(text: bytes) -> list[list[str]]:
    """The symbols behind each identifier tag of a text in lower case, up to the first that can't belong to an expression."""
    found = []
    tags = list(TAG_START.finditer(text))
    for tag, after in zip(tags, [*tags[1:], None], strict=True):
        stop = after.start() if after else len(text)
        line = LINE_END.search(text, tag.end(), stop)
        at, stop, symbols = tag.end(), line.start() if line else stop, []
        while (m := SYMBOL.match(text, at, stop)) is not None:
            symbol = (m[1] or m[2].rstrip(b".:-")).decode()
            if not (m[1] or symbol in BINDS or is_identifier(symbol)):
                break
            symbols.append(symbol)
            at = m.end()
            if m[2] and len(symbol) < len(m[2]):  # a mark at the end of the word ends the expression
                break
        found.append(symbols)
    return found


def permits(label: str) -> bool:
    return label.startswith(PERMISSIVE) and not label.startswith(RESTRICTED)


def evaluate(postfix: list[str]) -> tuple[list[str], bool]:
    """Licences named by an expression (an exception stays joined to its licence), and whether it grants permissive use: any side of or, both of and."""
    stack: list[tuple[list[str], bool]] = []
    for symbol in postfix:
        if symbol not in BINDS:
            stack.append(([symbol], permits(symbol)))
            continue
        (right, free_right), (left, free_left) = stack.pop(), stack.pop()
        if symbol == "with":
            stack.append((left[:-1] + [f"{left[-1]}-with-{right[0]}"] + right[1:], free_left))
        else:
            stack.append((left + right, free_left or free_right if symbol == "or" else free_left and free_right))
    return stack[0] if stack else ([], False)


def scan(text: bytes, finder: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, permissive) of a text in UTF-8."""
    words = text.translate(WORD_BYTES).split()
    plain = (b" " + b" ".join(words) + b" ").decode("latin-1")
    places, base, labels, missed, tagged = [], set(), set(), 1.0, False
    free: bool | None = None
    gaps = None
    for end, (length, label, kind) in finder.iter(plain):
        if kind == "base":
            gaps = np.flatnonzero(np.frombuffer(plain.encode("latin-1"), np.uint8) == 0x20) if gaps is None else gaps
            places.append(int(np.searchsorted(gaps, end - length)))
            base.add(label)
        if kind == "tag":
            tagged = True
            continue
        labels.add(label)
        missed *= 1 - WEIGHTS[kind]
        free = permits(label) if free is None else free and permits(label)
    if tagged:
        for symbols in expressions(text.translate(LOWER)):
            named, granted = evaluate(to_postfix(symbols))
            labels.update(named)
            if named:
                missed *= 1 - WEIGHTS["tag"]
                free = granted if free is None else free and granted
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1 - missed, free


LOWER = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b for b in range(256))
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("permissive", pa.bool_())])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row for each row of `docs(doc_id, text)`: counts and places of base phrases, labels, an evidence score from 0 to 1
    (notices and tags combined as independent), and whether the licences found permit free use (null without any).
    Cases as above."""

    def run(parts):
        finder = automaton({**BASE_PHRASES, **MORE_PHRASES, TAG: ""})
        for part in parts:
            texts = part.column(1).cast(pa.binary()).to_pylist()
            found = list(zip(*(scan(t or b"", finder) for t in texts), strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), *(pa.array(col, SCHEMA.types[i + 1]) for i, col in enumerate(found))], schema=SCHEMA)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permissive boolean")
