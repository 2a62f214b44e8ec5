"""License scans: Aho-Corasick finds licence notice phrases and identifier tags; a shunting-yard parser evaluates the licence expressions behind tags."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from textmill.llm.common import ASCII_LOWER, prepare

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notices, as words, with the label and how sure a single notice makes it.
NOTICES = {
    "mit license": ("mit", 0.8), "the mit licence": ("mit", 0.8), "apache license 2 0": ("apache-2", 0.9), "apache 2 0 license": ("apache-2", 0.9),
    "gnu general public license": ("gpl", 0.8), "gnu general public license version 2": ("gpl-2", 0.9), "gnu general public license version 3": ("gpl-3", 0.9),
    "gnu lesser general public license": ("lgpl", 0.9), "gnu affero general public license": ("agpl", 0.9), "mozilla public license": ("mpl", 0.9),
    "bsd 2 clause": ("bsd-2", 0.9), "bsd 3 clause": ("bsd-3", 0.9), "redistribution and use in source and binary forms": ("bsd", 0.8),
    "permission is hereby granted free of charge": ("mit", 0.7), "eclipse public license": ("epl", 0.9), "boost software license": ("bsl-1", 0.9),
    "creative commons attribution": ("cc-by", 0.7), "creative commons zero": ("cc0", 0.9), "cc by sa": ("cc-by-sa", 0.8), "cc by nd": ("cc-by-nd", 0.8), "cc0 1 0": ("cc0", 0.9),
    "released into the public domain": ("public-domain", 0.8), "the unlicense": ("unlicense", 0.8), "all rights reserved": ("all-rights-reserved", 0.5),
}
#: Identifiers of the public licence list that allow use in any work under notice alone, in lower case.
PERMISSIVE_IDS = frozenset(
    "0bsd aal afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 apache-1.0 apache-1.1 apache-2.0 artistic-2.0 blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent "
    "bsd-2-clause-views bsd-3-clause bsd-3-clause-attribution bsd-3-clause-clear bsd-3-clause-lbnl bsd-4-clause bsd-4-clause-uc bsd-source-code bsl-1.0 bzip2-1.0.6 "
    "cc0-1.0 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-pddc cecill-b curl ecl-1.0 ecl-2.0 efl-2.0 entessa fsfap ftl hpnd icu ijg imagemagick isc json "
    "libpng libpng-2.0 libtiff miros mit mit-0 mit-advertising mit-cmu mit-feh mit-modern-variant mulanpsl-1.0 mulanpsl-2.0 naist-2003 ncsa nist-pd ntp odc-by-1.0 "
    "oldap-2.8 openssl pddl-1.0 php-3.0 php-3.01 postgresql psf-2.0 python-2.0 ruby tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xnet zlib "
    "zlib-acknowledgement zpl-2.0 zpl-2.1".split()
)
#: What stands for no licence at all.
NO_LICENCE = frozenset(("none", "noassertion"))
#: Labels of families, by how their identifiers begin; other identifiers are their own labels.
FAMILIES = (
    ("apache-2.0", "apache-2"), ("bsd-2-clause", "bsd-2"), ("bsd-3-clause", "bsd-3"), ("gpl-2.0", "gpl-2"), ("gpl-3.0", "gpl-3"), ("lgpl-", "lgpl"), ("agpl-", "agpl"),
    ("mpl-2.0", "mpl"), ("epl-", "epl"), ("bsl-1.0", "bsl-1"), ("cc0-1.0", "cc0"), ("cc-by-nc-nd-", "cc-by-nc-nd"), ("cc-by-nc-sa-", "cc-by-nc-sa"), ("cc-by-nc-", "cc-by-nc"),
    ("cc-by-nd-", "cc-by-nd"), ("cc-by-sa-", "cc-by-sa"), ("cc-by-", "cc-by"),
)


def label_of(identifier: str) -> str:
    """The label of an identifier in lower case: its family's, or itself."""
    return next((label for start, label in FAMILIES if identifier.startswith(start)), identifier)


PERMISSIVE = frozenset(label_of(x) for x in PERMISSIVE_IDS) | {"bsd", "public-domain"}
TAG = "spdx-license-identifier"
EXPRESSION = re.compile(r"[ \t]*:?[ \t]*((?:[A-Za-z0-9.+:\-]+|[() \t])+)")
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:\-]+")
RANK = {"or": 1, "and": 2, "with": 3}


WELL_FORMED = re.compile(r"[a-z0-9][a-z0-9.\-]*(?::[a-z0-9][a-z0-9.\-]*)?\+?")


def operand(token: str, before: str, after: str) -> str | None:
    """The identifier that a token is, in lower case without the + of later versions; None if the token is no identifier. Identifiers that no list has count too: a plain word is one only where the grammar wants an operand on both sides of it, not in the prose that may follow a tag on its line."""
    name = token.lower().rstrip(".:")
    if not WELL_FORMED.fullmatch(name) or name in NO_LICENCE:
        return None
    bare = name.removesuffix("+")
    if bare in PERMISSIVE_IDS or label_of(bare) != bare or re.search(r"[0-9\-]", bare):
        return bare
    prose = after and after not in "()" and after.lower() not in RANK or before.islower() and token.islower()
    return None if prose else bare


def parse_expression(text: str) -> tuple[tuple[str, ...], bool | None]:
    """The labels of a licence expression, and whether its terms can be met by permissive licences alone (or: either side, and: both, with: the left side); (), None if it is malformed from the start. An identifier that is not known is a label of its own and not permissive.

    A shunting-yard: operands go to the output, operators wait on a stack until one of lower rank or a bracket comes. The longest well-formed beginning counts, as prose may follow a tag on its line.
    """
    out: list[tuple[frozenset, bool]] = []
    stack: list[str] = []
    best: tuple[tuple[str, ...], bool | None] = ((), None)
    last = False  # whether an operand came last
    before = ""

    def apply(values: list, op: str) -> None:
        b, a = values.pop(), values.pop()
        if op == "or":
            values.append((a[0] | b[0], a[1] or b[1]))
        elif op == "and":
            values.append((a[0] | b[0], a[1] and b[1]))
        else:
            values.append(a)

    tokens = TOKEN.findall(text)
    for tok, after in zip(tokens, [*tokens[1:], ""], strict=True):
        low = tok.lower()
        if tok == "(":
            if last:
                break
            stack.append(tok)
        elif tok == ")":
            if not last or "(" not in stack:
                break
            while stack[-1] != "(":
                apply(out, stack.pop())
            stack.pop()
        elif low in RANK:
            if not last:
                break
            while stack and stack[-1] != "(" and RANK[stack[-1]] >= RANK[low]:
                apply(out, stack.pop())
            stack.append(low)
            last = False
        else:
            if last:
                break
            if stack and stack[-1] == "with":
                out.append((frozenset(), True))
            else:
                name = operand(tok, before, after)
                if name is None:
                    break
                label = label_of(name)
                out.append((frozenset([label]), label in PERMISSIVE))
            last = True
        before = tok if low in RANK else ""
        if last and "(" not in stack:
            values = list(out)
            for op in reversed(stack):
                apply(values, op)
            best = tuple(sorted(values[0][0])), values[0][1]
    return best


@functools.cache
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES}:
        a.add_word(f" {phrase} ", phrase)
    a.make_automaton()
    return a


@functools.cache
def tags() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word(TAG, TAG)
    a.make_automaton()
    return a


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, permissive) of one text."""
    low = (text or "").translate(ASCII_LOWER)
    words = WORDS.findall(low)
    joined = f" {' '.join(words)} "
    n_base, first, last, base, more, keep = 0, None, None, set(), set(), 1.0
    at, seen = 0, 0  # places are counted forward only
    hits = sorted((end - len(p) - 1, p) for end, p in automaton().iter(joined))
    for start, phrase in hits:
        seen += joined.count(" ", at, start)
        at = start
        if phrase in BASE:
            n_base += 1
            first = seen if first is None else first
            last = seen
            base.add(BASE[phrase])
            keep *= 0.05
        if phrase in NOTICES:
            label, sure = NOTICES[phrase]
            more.add(label)
            keep *= 1 - sure
    found, permissive = [], None
    if "spdx" in low:
        for end, tag in tags().iter(low):
            m = EXPRESSION.match(text, end + 1)
            labels, ok = parse_expression(m[1]) if m else ((), None)
            if labels:
                found.append(m[1].strip())
                more.update(labels)
                permissive = ok if permissive is None else permissive and ok
                keep *= 0.02
    # a longer notice says more than the shorter one that it begins with
    if {"gpl-2", "gpl-3"} & more:
        more.discard("gpl")
    labels = base | more
    if permissive is None and labels:
        permissive = labels <= PERMISSIVE
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1 - keep, found, permissive


def scan_licenses(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, permissive.

    Null and empty texts have no words, empty label strings, score 0 and null places. Every text is scanned whole, however long; overlapping phrases each count. Rows are judged alone: repeated rows and ids give repeated results, a null doc_id stays null, an empty table gives none; other columns of docs, whatever their names, are not read. permissive: null without labels, false where a label is not known.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.bool_()]
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "permissive"]
        for b in batches:
            rows = list(zip(*map(scan, b.column(1).to_pylist()), strict=True)) or [()] * 9
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(r, k) for r, k in zip(rows, kinds, strict=True))], ["doc_id", *names])

    return docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"cast(`{text}` as string) as text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, permissive boolean")
