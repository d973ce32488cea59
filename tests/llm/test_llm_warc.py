import hashlib

from pyspark.sql import functions as F

from eventlake.llm import warc as R

SCHEMA = "page_id long, url string, html string"


def pages(spark, n=3000):
    rows = [(i, f"http://h{i % 7}.net/{i}", f"<p>{'x' * (i % 50)}é{i}</p>") for i in range(n)]
    rows += [(None, None, None), (n, "u", ""), (None, "http://a", "b"), (5, "http://h5.net/5", "again"), (5, "http://h5.net/5", "again"), (n + 1, "long", "z" * 500_000)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"file": F.lit("mine"), "pos": F.lit(1), "offset": F.lit(2), "hash": F.lit(3)})


def brute_root(records):
    """Leaves and levels of one file by the definition."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    level = [(r["offset"], r["offset"] + r["length"], sha(f"{r['pos']}:{r['offset']}:{r['length']}:{r['digest']}")) for r in records]
    while len(level) > 1:
        cut = [level[i : i + R.FANOUT] for i in range(0, len(level), R.FANOUT)]
        level = [(c[0][0], c[-1][1], sha(f"{c[0][0]}:{c[-1][1]}:{','.join(x[2] for x in c)}")) for c in cut]
    return level[0]


def test_records_tile_their_file_and_hash_their_bytes(spark):
    df = pages(spark)
    rows = R.archive(df).collect()
    assert len(rows) == df.count()
    by = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["pos"])):
        mine = by.setdefault(r["file"], [])
        assert r["pos"] == len(mine) and r["offset"] == sum(m["length"] for m in mine)
        mine.append(r)
    assert 3 < len(by) < 12
    text = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:3>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: http://h3.net/3\r\nContent-Type: text/html\r\nContent-Length: 13\r\n\r\n<p>xxxé3</p>\r\n\r\n"
    row = next(r for r in rows if r["page_id"] == 3)
    assert row["digest"] == hashlib.sha256(text.encode()).hexdigest() and row["length"] == len(text.encode())


def test_roots_match_brute_force(spark):
    rows = R.archive(pages(spark)).cache()
    levels = R.merkle(rows)
    top = {r["file"]: (r["lo"], r["hi"], r["hash"]) for r in levels[-1].collect()}
    by = {}
    for r in rows.orderBy("file", "pos").collect():
        by.setdefault(r["file"], []).append(r)
    for file, records in by.items():
        root = brute_root(records)
        n, height = len(records), 0
        while n > 1:
            n, height = -(-n // R.FANOUT), height + 1
        if height == len(levels) - 1:
            assert top[file] == root


def located(left, right):
    return {(r["file"], r["node"]) for r in R.audit(R.merkle(left), R.merkle(right)).collect()}


def test_audit_locates_what_differs(spark):
    ours = R.archive(pages(spark)).cache()
    rows = {(r["file"], r["pos"]): r for r in ours.collect()}
    assert located(ours, ours) == set()
    bad = {k for k in rows if (k[0] + k[1]) % 97 == 0}
    changed = ours.withColumn("digest", F.when((F.col("file") + F.col("pos")) % 97 == 0, F.lit("bad")).otherwise(F.col("digest")))
    assert located(ours, changed) == bad
    short = ours.where("pos < 100")
    assert located(ours, short) == {k for k in rows if k[1] >= 100} == located(short, ours)
    assert located(ours, ours.limit(0)) == set(rows)
    assert located(ours.limit(0), ours.limit(0)) == set()


def test_damaged_replica(spark):
    df = pages(spark)
    ours, theirs = R.archive(df), R.archive(R.damaged(df, every=40))
    found = located(ours, theirs)
    want = {(a["file"], a["pos"]) for a, b in zip(ours.orderBy("file", "pos").collect(), theirs.orderBy("file", "pos").collect()) if a["digest"] != b["digest"]}
    assert found == want and 20 < len(found) < 200
    assert R.archive(df.limit(0)).count() == 0


def test_the_archive_is_stored_and_what_is_stored_is_audited(spark):
    df = pages(spark, 1500)
    stored = R.store(df)
    assert stored.inputFiles() and dict(stored.dtypes)["payload"] == "binary"
    files = {}
    for r in stored.orderBy("file", "place").collect():
        files[r["file"]] = files.get(r["file"], b"") + bytes(r["payload"])
    listed = R.records(stored).collect()
    for r in listed:
        data = files[r["file"]][r["offset"] : r["offset"] + r["length"]]
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n") and hashlib.sha256(data).hexdigest() == r["digest"]
    assert sum(map(len, files.values())) == sum(r["length"] for r in listed) and len(listed) == df.count()
    ours, place = R.records(stored).cache(), (F.col("file") == 1) & (F.col("place") == 100)
    keys = {(r["file"], r["pos"]) for r in listed}
    behind = {k for k in keys if k[0] == 1 and k[1] >= 100}
    flipped = F.concat(F.expr("substring(payload, 1, octet_length(payload) - 5)"), F.lit(b"~"), F.expr("substring(payload, -4)"))
    cut = F.expr("substring(payload, 1, octet_length(payload) - 1)")
    for value, want in ((flipped, {(1, 100)}), (cut, behind)):
        assert located(ours, R.records(stored.withColumn("payload", F.when(place, value).otherwise(F.col("payload"))))) == want
    assert located(ours, R.records(stored.where(~place))) == behind


def test_damaged_copies_of_every_kind(spark):
    stored = R.store(pages(spark, 1500))
    rows = {(r["file"], r["place"]): r for r in stored.collect()}
    ours = R.records(stored).cache()
    for kind in ("changed", "cut", "lost"):
        theirs = R.damaged_copy(stored, **{"changed": None, kind: 40})
        have = {(r["file"], r["place"]): bytes(r["payload"]) for r in theirs.collect()}
        touched = {k for k, r in rows.items() if have.get(k) != bytes(r["payload"])}
        assert 10 < len(touched) < 100
        same = {k for k in touched if k in have and len(have[k]) == len(rows[k]["payload"])}
        moved = {k: min((p for f, p in touched - same if f == k[0]), default=10**9) for k in rows}
        assert bool(same) == (kind == "changed")
        assert located(ours, R.records(theirs)) == touched | {k for k in rows if k[1] >= moved[k]}
    for k, r in rows.items():
        if r["page_id"] == 3:
            head, body = bytes(r["payload"]).split(b"\r\n\r\n", 1)
            got = R.damaged_copy(stored.where("page_id = 3"), changed=1).first()["payload"]
            assert bytes(got) == head + b"\r\n\r\n?" + body[1:]


def test_record_ends_come_from_their_headers(spark):
    """Read by Content-Length alone, a file's bytes give its records."""
    odd = spark.createDataFrame([(1, "http://a/\r\n\r\nContent-Length: 9", "x\r\n\r\ny"), (2, "é", None), (3, None, "日本" * 40), (None, "", "")], SCHEMA)
    for df in (odd, pages(spark, 200)):
        stored = R.store(df)
        told = {(r["file"], r["pos"]): r for r in R.records(stored).collect()}
        assert not any(r["torn"] for r in told.values())
        files = {}
        for r in stored.orderBy("file", "place").collect():
            files[r["file"]] = files.get(r["file"], b"") + bytes(r["payload"])
        for file, data in files.items():
            at = pos = 0
            while at < len(data):
                head = data.index(b"\r\n\r\n", at) + 4
                fields = dict(x.split(b": ", 1) for x in data[at:head].split(b"\r\n")[1:] if x)
                assert data[at:].startswith(b"WARC/1.1\r\n") and set(fields) >= {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"}
                end = head + int(fields[b"Content-Length"]) + 4
                r = told[file, pos]
                assert data[end - 4 : end] == b"\r\n\r\n" and (r["offset"], r["length"]) == (at, end - at)
                assert r["digest"] == hashlib.sha256(data[at:end]).hexdigest()
                at, pos = end, pos + 1


def test_torn_records_are_told_and_later_ones_are_shifted(spark):
    stored = R.store(pages(spark))
    copy = R.damaged_copy(stored, changed=None, cut=300, lost=None, cut_bytes=4)
    ours, theirs = R.records(stored), R.records(copy)
    torn = {(r["file"], r["pos"]) for r in theirs.where("torn").collect()}
    assert 2 < len(torn) < 40
    first = {}
    for file, pos in torn:
        first[file] = min(pos, first.get(file, pos))
    want = {(r["file"], r["pos"]) for r in ours.collect() if r["pos"] >= first.get(r["file"], 1 << 60)}
    assert located(ours, theirs) == want
