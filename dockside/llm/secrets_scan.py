"""Secret scans through a trigram index.

From each rule's regular expression follows a Boolean query over trigrams that
every match must hold (in lower case).  The index is partitioned by document: a
task posts the trigrams that any query uses, for the texts of one batch, so
nothing is shuffled and no posting list grows with the input.  Per rule the
postings are intersected and united, and the candidates are verified with the
expression itself.  A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product
from re import _constants as sre
from re import _parser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockside.llm.common import whole_text

#: Strings followed at once while a query is derived; beyond that their trigrams so far are kept.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, which group must have a least length, and flags."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    flags: int = re.ASCII
    expression: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "expression", re.compile(self.pattern, self.flags))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Start and end of each match, leftmost and non-overlapping, that is long enough."""
        return [m.span() for m in self.expression.finditer(text) if len(m[self.group]) >= self.least]


# The base kinds.  Runs of hex digits are taken whole, so asking
# for the least length in the pattern finds the same runs.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        flags=re.ASCII | re.IGNORECASE,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}", least=24),
)

# Further kinds, by their public prefixes.
MORE_RULES = (
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[sr]k_live_[A-Za-z0-9]{20,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("privatekey", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

RULES = BASE_RULES + MORE_RULES

#: A query is None (any text), a trigram, or ("and" | "or", queries).
Query = None | str | tuple


def all_of(*queries: Query) -> Query:
    parts = list(dict.fromkeys(q for q in queries if q is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def any_of(*queries: Query) -> Query:
    parts = list(dict.fromkeys(queries))
    return None if None in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def trigrams_of(strings: set[str]) -> Query:
    """What a text that holds one of the strings must hold."""
    return any_of(*[all_of(*[s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def derived(parsed) -> tuple[set[str] | None, Query]:
    """The strings a parsed expression matches, if they are few, and the query of its matches."""
    exact: set[str] | None = {""}
    query: Query = None
    for op, value in parsed:
        strings, more = derived_one(op, value)
        joined = None
        if exact is not None and strings is not None and len(exact) * len(strings) <= MOST_STRINGS:
            joined = {a + b for a, b in product(exact, strings)}
        if joined is None:
            query = all_of(query, trigrams_of(exact) if exact is not None else None, more)
            exact = strings if strings is not None else {""}
            query = all_of(query, None)
            if strings is None:
                # A gap of unknown text: what follows starts anew.
                return gap(parsed, op, value, query)
        else:
            exact = joined
            query = all_of(query, more)
    return exact, query


def gap(parsed, op, value, query: Query) -> tuple[None, Query]:
    """The query of the whole when one element matches unknown text."""
    rest = list(parsed)
    after = rest[next(i for i, item in enumerate(rest) if item[0] is op and item[1] is value) + 1 :]
    strings, more = derived(after)
    return None, all_of(query, more, trigrams_of(strings) if strings is not None else None)


def derived_one(op, value) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {chr(value).lower()}, None
    if op is sre.SUBPATTERN:
        return derived(value[-1])
    if op is sre.BRANCH:
        parts = [derived(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in parts):
            union = set().union(*[strings for strings, _ in parts])
            if len(union) <= MOST_STRINGS:
                return union, None
        return None, any_of(*[all_of(q, trigrams_of(s) if s is not None else None) for s, q in parts])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = value
        strings, query = derived(body)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, None
        if least == most == 1:
            return strings, query
        if least == 0:
            return None, None
        return None, all_of(query, trigrams_of(strings) if strings is not None else None)
    if op is sre.IN and all(kind is sre.LITERAL for kind, _ in value) and len(value) <= 8:
        return {chr(c).lower() for _, c in value}, None
    if op is sre.AT:
        return {""}, None
    return None, None


def query_of(rule: Rule) -> Query:
    """The trigram query of a rule; None if it has no mandatory trigram."""
    strings, query = derived(_parser.parse(rule.pattern, rule.flags))
    return all_of(query, trigrams_of(strings) if strings is not None else None)


def used_trigrams(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(used_trigrams, query[1:]))


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class TrigramIndex:
    """Postings, by text number, of the wanted trigrams in some texts."""

    def __init__(self, wanted: list[str]):
        self.wanted = wanted
        self.number = np.zeros(1 << 24, dtype=np.uint16)
        for i, t in enumerate(wanted):
            a, b, c = t.encode("ascii")
            self.number[a << 16 | b << 8 | c] = i + 1

    def post(self, texts: list[str]) -> dict[str, np.ndarray]:
        # A text ends with a zero byte, which is in no wanted trigram.
        raw = [t.encode("utf-8", "surrogatepass").translate(LOWER) + b"\0\0" for t in texts]
        ends = np.cumsum([len(r) for r in raw])
        codes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        if len(codes) < 3:
            return {}
        at = codes[:-2].astype(np.uint32) << 16
        at |= codes[1:-1].astype(np.uint32) << 8
        at |= codes[2:]
        found = self.number[at]
        places = np.flatnonzero(found)
        owners = np.searchsorted(ends, places, side="right")
        pairs = np.unique(found[places].astype(np.int64) << 32 | owners)
        numbers, owners = pairs >> 32, pairs & 0xFFFFFFFF
        cuts = np.searchsorted(numbers, np.arange(1, len(self.wanted) + 2))
        return {t: owners[cuts[i] : cuts[i + 1]] for i, t in enumerate(self.wanted)}


def candidates(query: Query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the texts that may match."""
    if query is None:
        return np.arange(n)
    if isinstance(query, str):
        return postings.get(query, np.zeros(0, dtype=np.int64))
    parts = sorted((candidates(q, postings, n) for q in query[1:]), key=len)
    merged = parts[0]
    for part in parts[1:]:
        merged = np.intersect1d(merged, part, assume_unique=True) if query[0] == "and" else np.union1d(merged, part)
    return merged


class Scanner:
    """Finds all spans of all rules in a list of texts."""

    #: Characters indexed at a time; a single text may be longer.
    AT_ONCE = 4_000_000

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.queries = [query_of(rule) for rule in rules]
        self.index = TrigramIndex(sorted(set().union(*map(used_trigrams, self.queries))))

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text, its (start, number of the rule, end) in order."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= self.AT_ONCE):
                size += len(texts[end])
                end += 1
            part = texts[begin:end]
            postings = self.index.post(part)
            for k, (rule, query) in enumerate(zip(self.rules, self.queries, strict=True)):
                for i in candidates(query, postings, len(part)).tolist():
                    found[begin + i].extend((start, k, stop) for start, stop in rule.spans(part[i]))
            begin = end
        for spans in found:
            spans.sort()
        return found


def listed(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[k].kind}:{start}:{end}" for start, k, end in spans)


def scanned(documents: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """doc_id, a count per base kind, base_sha256 and all spans of each row.

    Places are code points, ends exclusive.  A missing text counts as empty; rows
    that repeat are scanned alike; an empty table gives no rows.
    """
    counts = [f"n_{rule.kind}" for rule in rules[:base]]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(rules)
        for batch in batches:
            found = scanner.scan(batch["text"].tolist())
            of_base = [[s for s in spans if s[1] < base] for spans in found]
            out = {"doc_id": batch["doc_id"].astype("Int64")}
            for k, name in enumerate(counts):
                out[name] = [sum(s[1] == k for s in spans) for spans in of_base]
            out["base_sha256"] = [hashlib.sha256(listed(spans, rules).encode()).hexdigest() for spans in of_base]
            out["spans"] = [listed(spans, rules) for spans in found]
            yield pd.DataFrame(out)

    given = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    schema = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in counts], "base_sha256 string", "spans string"])
    return given.mapInPandas(scan, schema)


def masked(documents: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """All rows and columns of ``documents``, each stretch of secrets replaced by ``mask``.

    A missing text stays missing, an empty one empty; very long ones are masked whole.
    Overlapping spans are one stretch.  Rows that repeat are masked alike; an empty
    table gives no rows.
    """

    def hide(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(rules)
        for batch in texts:
            given = [t if t is not None else "" for t in batch]
            out = []
            for original, text, spans in zip(batch, given, scanner.scan(given), strict=True):
                parts, at = [], 0
                for start, _, end in spans:
                    if start >= at:
                        parts += [text[at:start], mask]
                    at = max(at, end)
                out.append("".join([*parts, text[at:]]) if spans else original)
            yield pd.Series(out, dtype=object)

    text = F.pandas_udf(hide, "string")(F.col("text").cast("string"))
    hidden = documents.withColumn("text", text)
    if "n_chars" in documents.columns:
        hidden = hidden.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return hidden.select(*[F.col(f"`{c}`") for c in documents.columns])
