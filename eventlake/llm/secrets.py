"""Secret scans with one deterministic automaton for all rules.

A rule is a pattern, the group that is the secret, and the least number of
characters of that group. The patterns are compiled into one automaton, and
every text is scanned once, byte by byte, for all rules together. The pass
reports, segment by segment, which rules match there: a segment ends at a byte
that no match can hold, such as a line end. Only in reported segments an exact
check takes the leftmost non-overlapping matches of the reported rules and
drops those that are too short; as no match reaches over a segment's end, they
are those of the whole text. A private key's header is one line, its body goes
on: that rule is matched from the reported header on.

All of it is linear in the text, however hostile: the patterns match possessively
or cannot be retried inside what they have read.

Spans are code points of the original text, end exclusive. Kinds are listed
base first; more rules add spans and never change those of others. Null and
empty texts have none. Rows are independent: nothing is shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm.automaton import Automaton
from eventlake.llm.common import append_struct, table


@dataclass(frozen=True)
class Rule:
    """``least`` is the number of characters that ``group`` needs."""

    kind: str
    pattern: str
    group: int
    least: int
    #: What the automaton looks for: fits every match that is long enough. A
    #: rule without a rare beginning counts here, the others needn't: counters
    #: that run side by side multiply the automaton's states.
    sieve: str = ""
    #: Whether a match goes on behind what the automaton looks for.
    beyond: bool = False


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])
PEM = "-----BEGIN ([A-Z ]*)PRIVATE KEY-----"
#: Line ends of a key's text, also as strings escape them.
ENDS = "(?:\\s|\\\\[rn])"
#: A private key: up to the END line of its label before any other BEGIN line,
#: or else its header and base64 lines.
PRIVATE_KEY = (
    PEM + "(?:(?:(?!-----BEGIN )[\\s\\S])*?-----END \\1PRIVATE KEY-----"
    f"|(?:{ENDS}*(?:Proc-Type|DEK-Info):[^\\r\\n\\\\]*)*(?:(?:{ENDS}*[A-Za-z0-9+/]{{16,}}+={{0,2}})++(?:(?:\\r?\\n|(?:\\\\r)?\\\\n)[A-Za-z0-9+/]+={{0,2}}(?=[\\r\\n\\\\]|\\Z))?)?)")
BASE = (
    Rule("assign", "(" + NAMES + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32, "[0-9a-f]{32}"),
)
MORE = (
    Rule("github", "gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    # At the start of a run of token characters: retries inside the run would be quadratic.
    Rule("jwt", "(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\\.eyJ[A-Za-z0-9_-]++\\.[A-Za-z0-9_-]++", 0, 20,
         "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+"),
    Rule("private_key", PRIVATE_KEY, 0, 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", True),
)

SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FIELDS = T.StructType([T.StructField("spans", T.ArrayType(SPAN))])


@lru_cache(maxsize=4)
def automaton(rules: tuple[Rule, ...]) -> Automaton:
    return Automaton([r.sieve or r.pattern for r in rules])


class Scanner:
    def __init__(self, rules: tuple[Rule, ...], machine: Automaton):
        self.rules = rules
        self.exact = [re.compile(r.pattern) for r in rules]
        self.machine = machine

    def scan(self, texts: list[str | None]) -> dict[str, list]:
        whole = [t or "" for t in texts]
        encoded = [t.encode() for t in whole]
        sizes = np.array([len(e) for e in encoded], np.int64)
        data = np.frombuffer(b"".join(encoded), np.uint8)
        starts, ends, masks = self.machine.segments(data, sizes)
        before = np.cumsum(sizes) - sizes
        owner = np.searchsorted(before, starts, side="right") - 1
        # The last of several texts that begin there: those before it are empty.
        found: list[list[tuple[int, int, int]]] = [[] for _ in whole]
        upto = [0] * len(whole) * len(self.rules)  # where a rule's last match ends
        points: dict[int, np.ndarray] = {}
        for i, a, b, mask in zip(owner.tolist(), starts.tolist(), ends.tolist(), masks.tolist()):
            a, b = a - int(before[i]), b - int(before[i])
            if len(encoded[i]) != len(whole[i]):  # bytes to code points
                if i not in points:
                    mine = data[before[i] : before[i] + sizes[i]]
                    points = {i: np.concatenate([[0], np.cumsum(mine & 0xC0 != 0x80)])}
                a, b = int(points[i][a]), int(points[i][b])
            for r, rule in enumerate(self.rules):
                if mask >> r & 1:
                    at = i * len(self.rules) + r
                    for m in self.exact[r].finditer(whole[i], max(a, upto[at]), len(whole[i]) if rule.beyond else b):
                        if rule.beyond and m.start() >= b:
                            break
                        upto[at] = m.end()
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found[i].append((m.start(), r, m.end()))
        return {"spans": [[{"kind": self.rules[r].kind, "start": a, "end": b} for a, r, b in sorted(f)] for f in found]}


def find_secrets(df: DataFrame, out: str = "secrets", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """``df`` with a struct column ``out`` that holds ``spans``: kind, start
    and end of every secret, by start and then by the order of the rules."""
    sent = df.sparkSession.sparkContext.broadcast(automaton(rules))  # its size depends on the rules alone
    return append_struct(df, out, FIELDS, Scanner.scan, text_col, lambda: Scanner(rules, sent.value))


def op8_secrets(spark, sf_dir):
    """Contract query: counts and digests of the secrets of every document."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets.spans")
    kinds = [r.kind for r in BASE]
    base = F.filter(spans, lambda s: s["kind"].isin(kinds))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, kinds), F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
