"""Secret scans: all rules in one pass of a combined deterministic automaton over a text's bytes.

Every rule is a pattern, a group whose length counts, and the least length. The
automaton is compiled from what every span of a rule must hold, so it marks each
text with a span, and no span is missed. Only in marked texts the rule's own pattern then fixes the spans: leftmost,
non-overlapping per kind, those with a short group dropped.

Defined results: a null or empty text has no spans; spans of different kinds may
overlap; positions are code points, the end exclusive; spans are sorted by
start, then kind as listed.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.automaton import Automaton, compile_rules
from shelfcast.llm.shipping import append_column
from shelfcast.llm.words import BLOCK_BYTES, column_bytes

#: Bytes of text scanned side by side.
SIDE_BY_SIDE = 16 * BLOCK_BYTES


@dataclass(frozen=True)
class Rule:
    """`head` is followed by `tail` characters, `least` or more of them, then by `close` and, as far as it goes, `body`."""

    kind: str
    head: str
    tail: str
    least: int
    close: str = ""
    any_case: bool = False
    mark: str = ""
    body: str = ""

    @property
    def pattern(self) -> str:
        return f"{self.head}({self.tail}+){self.close}{self.body}"

    @property
    def marking(self) -> str:
        """What the automaton looks for: every span of the rule holds it.

        Long counts of a tail that its head may recur in would multiply states, so
        only the first characters of a tail are counted, but for a bare run.
        """
        return self.mark or f"{self.head}{self.tail}{{{min(self.least, 4) if self.head else self.least}}}"


#: From a key's first line to its last, or without that to the last line of base64 (header lines, escaped line ends and quote marks included).
KEY_BODY = (
    r"(?:(?:(?!-----BEGIN)[\s\S])*?-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"""|(?:(?:\\[nrt]|[\s"'>|#*,])*(?:Proc-Type|DEK-Info|Version|Comment|Hash):(?:(?!\\n)[^\n])*)*"""
    r"""(?:(?:\\[nrt]|[\s"'>|#*,])*[A-Za-z0-9+/]{16,}={0,2})*"""
    r"""(?:[ \t"',]*(?:\\r)?(?:\r?\n|\\n)(?:\\[nrt]|[ \t"'>|#*,])*=?[A-Za-z0-9+/]+={0,2}(?=[ \t"',]*(?:\r?\n|\\[nr]|\Z)))*)"""
)
#: Fixed values of the first three kinds; the further ones are public token formats.
RULES = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=\-]", 6, any_case=True),
    Rule("access", "AKIA", "[A-Z0-9]", 16),
    Rule("hex", "", "[0-9a-f]", 24),
    Rule("private_key", "-----BEGIN", "[A-Z0-9 ]", 0, "PRIVATE KEY(?: BLOCK)?-----", mark="-----BEGIN", body=KEY_BODY),
    # Without a dot after it a first part is passed over whole, as every later start in it fails alike; its tail is then empty.
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]{8,}+(?:\.[A-Za-z0-9_\-]{8,}+\.", r"[A-Za-z0-9_\-]", 8, ")?", mark=r"eyJ[A-Za-z0-9_\-]{4}"),
    Rule("github", "gh[opsur]_", "[A-Za-z0-9]", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9\-]", 10),
    Rule("google", "AIza", r"[A-Za-z0-9_\-]", 35),
    Rule("stripe", "[rs]k_live_", "[A-Za-z0-9]", 16),
    Rule("bearer", r"[Bb]earer\x20+", r"[A-Za-z0-9._~+/\-]", 20),
    Rule("url_login", r"[A-Za-z]://[A-Za-z0-9._\-]+:", r"[A-Za-z0-9._~!$&+=%\-]", 1, "@", mark="[A-Za-z]://"),
)
BASE = ("assign", "access", "hex")
SPAN = "array<struct<kind:string,start:int,end:int>>"


@functools.lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...]) -> Automaton:
    return compile_rules([(r.marking, r.any_case) for r in rules])


@functools.lru_cache(maxsize=64)
def _exact(rule: Rule) -> re.Pattern:
    pattern = rule.pattern.replace(f"({rule.tail}+)", f"({rule.tail}*)") if rule.least == 0 else rule.pattern
    return re.compile(pattern.encode(), re.IGNORECASE if rule.any_case else 0)


def spans_of(text: bytes, rules: tuple[Rule, ...], mask: int) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) in bytes of the marked rules' spans."""
    found = []
    for bit, rule in enumerate(rules):
        if mask >> bit & 1:
            for m in _exact(rule).finditer(text):
                if m.end(1) - m.start(1) >= rule.least:
                    found.append((m.start(), bit, m.end()))
    return sorted(found)


def scan(df: DataFrame, text: str = "text", out: str = "spans", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`df` with the spans of each text."""
    machine = df.sparkSession.sparkContext.broadcast(automaton(rules))
    fields = [pa.field("kind", pa.string()), pa.field("start", pa.int32()), pa.field("end", pa.int32())]

    def spans(column: pa.Array) -> pa.Array:
        data, offsets = column_bytes(column)
        masks = np.zeros(len(column), np.int64)
        begin = 0
        while begin < len(column):
            end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + SIDE_BY_SIDE, "right")) - 1)
            masks[begin:end] = machine.value.scan(
                data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
            )
            begin = end
        rows: list[list[dict]] = [[] for _ in range(len(column))]
        for k in np.flatnonzero(masks).tolist():
            raw = data[offsets[k] : offsets[k + 1]]
            places = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            rows[k] = [
                {"kind": rules[bit].kind, "start": int(places[a]), "end": int(places[b])}
                for a, bit, b in spans_of(raw.tobytes(), rules, int(masks[k]))
            ]
        return pa.array(rows, pa.list_(pa.struct(fields)))

    return append_column(df, text, out, SPAN, spans, rows=20_000)


def listing(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """The spans, of some kinds if given, as kind:start:end joined by commas."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(df: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[secret]") -> DataFrame:
    """`df` with each run of overlapping spans in its texts replaced by `mark`."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    t = F.col(f"`{text}`")

    def add(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.when(fresh, t.substr(acc["at"] + 1, s["start"] - acc["at"])).otherwise(F.lit(""))
        return F.struct(
            F.concat(acc["done"], gap, F.when(fresh, F.lit(mark)).otherwise(F.lit(""))).alias("done"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    rest = F.lit(2**31 - 1)
    cleaned = F.aggregate(F.col(f"`{spans}`"), start, add, lambda acc: F.concat(acc["done"], t.substr(acc["at"] + 1, rest)))
    return df.withColumn(text, F.when(F.size(F.col(f"`{spans}`")) > 0, cleaned).otherwise(t))
