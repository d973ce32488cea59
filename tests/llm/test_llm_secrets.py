import random
import re

import numpy as np
import pytest
from llm_rows import clash, docs

from eventlake.llm import secrets as S
from eventlake.llm.automaton import Automaton

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


PARTS = ["password", "PassWd", "secret", "TOKEN", "api_key", "ApiKey", "=", ":", " ", "'", '"', "abcdefgh", "é", "K", "ſecret=", "AKIA",
         "ABCDEFGHIJKL", "0123456789abcdef", "f" * 31, "\U0001f600", "\n", "x", "token=token=", "ghp_" + "a" * 36, "xoxb-123456789012",
         "eyJhbGciOi.eyJzdWIiOi.abc-_", "-----BEGIN RSA PRIVATE KEY-----"]


def hard_texts():
    rnd = random.Random(7)
    return ["".join(rnd.choices(PARTS, k=rnd.randint(1, 14))) for _ in range(1500)]


def test_base_spans_match_brute_force():
    texts = [None, "", "no secret", "a" * 200_000 + " token: abcdefghi " + "0" * 70_000] + hard_texts()
    scanner = S.Scanner(S.BASE + S.MORE, S.automaton(S.BASE + S.MORE))
    for text, spans in zip(texts, scanner.scan(texts)["spans"]):
        got = [(s["kind"], s["start"], s["end"]) for s in spans]
        assert [g for g in got if g[0] in ("assign", "access", "hex")] == brute_base(text)
        assert [g[1] for g in got] == sorted(g[1] for g in got)


def test_the_automaton_reports_what_the_patterns_match():
    rules = S.BASE + S.MORE
    texts = hard_texts()
    for text, mask in zip(texts, S.automaton(rules).scan([t.encode() for t in texts]).tolist()):
        for i, rule in enumerate(rules):
            assert bool(mask >> i & 1) == bool(re.search(rule.sieve or rule.pattern, text)), (rule.kind, text)


@pytest.mark.parametrize("patterns", [["ab|cd"], ["a{2,3}b?", "[^a]c+"], ["(x|yz)*w", "a[^b]b", ""]])
def test_small_automata(patterns):
    rnd = random.Random(1)
    machine = Automaton(patterns)
    texts = ["".join(rnd.choices("abcdxyzw", k=rnd.randint(0, 9))) for _ in range(400)]
    for text, mask in zip(texts, machine.scan([t.encode() for t in texts]).tolist()):
        assert mask == sum(1 << i for i, p in enumerate(patterns) if re.search(p, text))
    assert len({(tuple(r), a) for r, a in zip(machine.table.tolist(), machine.rules.tolist())}) == len(machine.table)


def test_unsupported_patterns_are_refused():
    for pattern in ("a(?=b)", r"\d", "é", "^a"):
        with pytest.raises((ValueError, OverflowError)):
            Automaton([pattern])


def test_edge_rows(spark):
    rows = [(1, "token = 'abcdefgh'", "en", "a")] * 2 + [(2, None, None, None), (3, "", "en", "a"), (None, "\U0001f600" + "0" * 32, "en", "a")]
    df = clash(docs(spark, rows), "spans", "secrets", "kind")
    got = S.find_secrets(df).select("doc_id", "spans", "secrets.spans").collect()
    assert [(r[0], r[1], [tuple(s) for s in r[2]]) for r in got if r[2]] == [
        (1, "mine-spans", [("assign", 0, 17)])] * 2 + [(None, "mine-spans", [("hex", 1, 33)])]
    assert len(got) == 5 and S.find_secrets(df.limit(0)).count() == 0


def test_a_private_key_is_covered_whole():
    scanner = S.Scanner(S.BASE + S.MORE, S.automaton(S.BASE + S.MORE))
    body = "\n".join("Ab+/" * 16 for _ in range(4)) + "\nQUJD="
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    head = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-256-CBC,00\n\n"
    keys = [f"{begin}\n{body}\n{end}", f"{begin}\n{body[:-6]}", f"{begin}{head}{body}\n{end}", f"{begin}\r\n{body}", f"{begin}{head}{body}", begin,
            (f"{begin}\n{body}\n{end}").replace("\n", "\\n"), f"{begin}\n{body}\n-----BEGIN PRIVATE KEY-----\n{body}\n-----END PRIVATE KEY-----"]
    for key in keys:
        text = f"é see {key}\n\nand words after it"
        got = "".join(text[s["start"] : s["end"]] for s in scanner.scan([text])["spans"][0] if s["kind"] == "private_key")
        assert got == (key if key.count("BEGIN") == 1 else key.replace("\n-----BEGIN PRIV", "-----BEGIN PRIV")), key
    many = (begin + " x ") * 50_000
    assert len(scanner.scan([many])["spans"][0]) == 50_000


HOSTILE = {
    "plain": "lorem ipsum dolor sit amet " * 400_000, "one word": "a" * 10_000_000, "jwt starts": "eyJ" * 3_000_000 + " eyJa.eyJb.cccccccccccccc",
    "jwt dots": "eyJa." * 2_000_000, "names": "password" * 1_200_000, "blanks": "password" + " " * 10_000_000, "assigns": "token=a " * 1_200_000,
    "headers": "-----BEGIN " * 900_000, "begins": "-----BEGIN PRIVATE KEY-----" * 300_000, "hex": "0123456789abcde " * 600_000, "lines": "secret\n" * 1_400_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_ten_megabytes_take_seconds_and_bounded_memory(name):
    import time
    import tracemalloc

    text = HOSTILE[name]
    assert len(text) > 8_000_000
    scanner = S.Scanner(S.BASE + S.MORE, S.automaton(S.BASE + S.MORE))
    scanner.scan(["warm up password=abcdefgh"])
    began = time.process_time()
    got = scanner.scan([text])["spans"][0]
    assert time.process_time() - began < 20
    assert [g for g in got if g["kind"] == "jwt"] == ([{"kind": "jwt", "start": 9_000_001, "end": 9_000_025}] if name == "jwt starts" else [])
    small = text[: len(text) // 20]
    tracemalloc.start()
    scanner.scan([small])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(small) + (4 << 20)


def test_segments_hold_every_match_and_little_else():
    scanner = S.Scanner(S.BASE + S.MORE, S.automaton(S.BASE + S.MORE))
    texts = ["no secret here\n" * 50 + "password = 'abcdefgh1'\n" + "nor here\n" * 50, "", "é, AKIA" + "A" * 16 + "; ü"]
    encoded = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    starts, ends, masks = scanner.machine.segments(data, np.array([len(e) for e in encoded]))
    assert len(starts) == 2 and masks.tolist() == [1, 2] and max(ends - starts) < 60
    assert scanner.machine.shortest == len("AKIA") + 1


def test_spans_do_not_depend_on_what_stands_beside():
    """Texts in one batch, cut anywhere, give what each gives alone."""
    scanner, rnd = S.Scanner(S.BASE + S.MORE, S.automaton(S.BASE + S.MORE)), random.Random(12)
    texts = [None, ""] + ["".join(rnd.choices(PARTS + ["\n", "\n", ", "], k=rnd.randint(0, 30))) for _ in range(400)] + ["", "f" * 40]
    together = scanner.scan(texts)["spans"]
    assert together == [scanner.scan([t])["spans"][0] for t in texts]
