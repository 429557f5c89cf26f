"""URL filters: all wildcard rules run together as one bit-parallel Shift-And automaton."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from plumbline.llm.common import ascii_lower, slices, small_batches, strings

#: The symbol between host and path; bytes are 0 to 255.
GAP = 256
SYMBOLS = 257
#: Cells of the symbol matrix that is worked on at once.
CELLS = 4 << 20


@dataclass(frozen=True)
class Rule:
    """`block net/`: the host and its subdomains, if the path starts with the rule's.
    `block *casino*`: a glob (`*`, `?`) over host and path; `*` goes over any number of characters."""

    verdict: str
    pattern: str
    is_glob: bool = False


@dataclass
class Automaton:
    """Every position of every rule is one bit. Bits of a rule are adjacent, bit 0 of it is its
    start; `step[c]` are the bits that may be entered with symbol c, `stay[c]` the bits that a
    wildcard after them keeps alive over c."""

    step: np.ndarray
    stay: np.ndarray
    start: np.ndarray
    last: list[int]
    words: int = field(init=False)

    def __post_init__(self) -> None:
        self.words = self.step.shape[1]

    def matches(self, texts: list[np.ndarray]) -> np.ndarray:
        """For each text (symbols) and each rule: does the rule match the whole text?"""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        out = np.zeros((len(texts), len(self.last)), dtype=bool)
        order, at = np.argsort(-sizes, kind="stable"), 0
        while at < len(order):
            longest = int(sizes[order[at]])
            rows = order[at : at + max(1, CELLS // max(1, longest))]
            out[rows] = self._run([texts[i] for i in rows], sizes[rows])
            at += len(rows)
        return out

    def _run(self, texts: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """texts: by falling size, so that the rows still running are the first ones."""
        symbols = np.zeros((len(texts), int(sizes[0])), dtype=np.uint16)
        for row, text in zip(symbols, texts, strict=True):
            row[: len(text)] = text
        state = np.broadcast_to(self.start, (len(texts), self.words)).copy()
        running = len(texts)
        for at in range(symbols.shape[1]):
            while sizes[running - 1] <= at:
                running -= 1
            now, c = state[:running], symbols[:running, at]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:running] = (moved & self.step[c]) | (now & self.stay[c])
        bits = np.array(self.last)
        return (state[:, bits // 64] >> (bits % 64).astype(np.uint64)) & np.uint64(1) > 0


def compile_rules(rules: list[Rule]) -> Automaton:
    parts = [_symbols(rule) for rule in rules]
    total = sum(1 + sum(kind != "star" for kind, _ in part) for part in parts)
    words = -(-max(total, 1) // 64)
    step = np.zeros((SYMBOLS, words), dtype=np.uint64)
    stay = np.zeros((SYMBOLS, words), dtype=np.uint64)
    start = np.zeros(words, dtype=np.uint64)
    last, bit = [], 0
    for part in parts:
        start[bit // 64] |= np.uint64(1 << bit % 64)
        for kind, which in part:
            if kind != "star":
                bit += 1
            (stay if kind == "star" else step)[which, bit // 64] |= np.uint64(1 << bit % 64)
        last.append(bit)
        bit += 1
    return Automaton(step, stay, start, last)


def _symbols(rule: Rule) -> list[tuple[str, list[int]]]:
    anything = list(range(SYMBOLS))
    in_host = list(range(256))
    if rule.is_glob:
        out = []
        for b in rule.pattern.encode():
            if b == ord("*"):
                out.append(("star", anything))
            else:
                out.append(("one", in_host if b == ord("?") else [GAP] if b == ord("|") else [b]))
        return out
    host, slash, path = rule.pattern.partition("/")
    literal = [("one", [b]) for b in f".{host}".encode()]
    rest = [("one", [b]) for b in f"{slash}{path}".encode()]
    return [("star", in_host), *literal, ("one", [GAP]), *rest, ("star", anything)]


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    after = F.substring_index(_after(url), "/", 1)
    return ascii_lower(F.substring_index(F.substring_index(after, "?", 1), "#", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    rest = F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)
    at = F.instr(rest, "/")
    return F.when(at > 0, F.substr(rest, at)).otherwise("")


def _after(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def _judge(machine, rules: list[Rule], default: str, keep: list[str]):
    """Longest fitting rule wins; a tie goes to block, then to the rule named first."""
    rank = sorted(
        range(len(rules)),
        key=lambda i: (rules[i].is_glob, -len(rules[i].pattern), rules[i].verdict != "block", i),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = machine.value
        plain = np.array([not rules[i].is_glob for i in rank])
        for batch in slices(batches, "path"):
            texts = [
                np.concatenate(
                    [
                        np.frombuffer(f".{host}".encode(), np.uint8).astype(np.uint16),
                        np.array([GAP], np.uint16),
                        np.frombuffer(path.encode(), np.uint8).astype(np.uint16),
                    ]
                )
                for host, path in zip(
                    strings(batch.column("host")).to_pylist(),
                    strings(batch.column("path")).to_pylist(),
                    strict=True,
                )
            ]
            fits = automaton.matches(texts)[:, rank] if rules else np.zeros((len(texts), 1), bool)
            first = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
            won = [rules[rank[i]] if i >= 0 else None for i in first]
            is_rule = [i >= 0 and bool(plain[i]) for i in first]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array([r.pattern if p else None for r, p in zip(won, is_rule, strict=True)], pa.string()),
                    pa.array([r.verdict if r else default for r in won], pa.string()),
                    pa.array([None if p or r is None else r.pattern for r, p in zip(won, is_rule, strict=True)], pa.string()),
                ],
                [*keep, "rule", "verdict", "glob"],
            )

    return run


def judge_urls(
    pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per row of `pages`: struct `row`, `host`, `path`, `rule` (the winning host rule, or
    null), `verdict` and `glob` (the winning glob, if no host rule fits).

    Host rules come before globs; among either the longest wins. A url that no rule and no glob
    fits gets `default`. A null url, or one without `://`, has an empty host and path. The rules
    are a list in the program, so what is broadcast does not grow with the data.
    """
    small_batches(pages.sparkSession)
    machine = pages.sparkSession.sparkContext.broadcast(compile_rules(rules))
    rows = pages.select(
        F.struct("*").alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    extra = [StructField(c, StringType()) for c in ("rule", "verdict", "glob")]
    schema = StructType([*rows.schema, *extra])
    return rows.mapInArrow(_judge(machine, rules, default, rows.columns), schema)
