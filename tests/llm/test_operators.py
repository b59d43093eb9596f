"""Small tables with nulls, empty and repeated rows, ties and clashing columns, against brute force."""

import gzip
import hashlib
import io
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

W = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(rng, n):
    return [rng.choice(["alpha", "Beta", "gamma,", "delté", "x", "Straße"]) + str(rng.randint(0, 400)) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng, rows = random.Random(4), []
    for i in range(60):
        rows.append(" ".join(words(rng, rng.randint(1, 80))))
    for i in range(40):
        w = rows[i % 12].split(" ")
        for _ in range(i % 3):
            w[rng.randrange(len(w))] = "edit"
        rows.append(" ".join(w))
    rows += [rows[3]] * 5 + ["", None, " \n\t ", "one", "one two", "ONE two", "a b c d", "A B  C\nD"]
    return [(i * 3, t, rng.choice(["s1", "s2", "s3", None]), 7, 1, 1) for i, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    # n, rank and score clash with names that operators use; the last row repeats an id
    return spark.createDataFrame(corpus + [(0, None, None, 0, 0, 0), (None, "no id", "s1", 1, 1, 1)], "doc_id long, text string, source string, n int, rank int, score int").repartition(5)


def texts(corpus):
    return {i: t for i, t, *_ in corpus} | {0: None}  # min(text) of a repeated id: null sorts first


def test_ngram_join_equals_brute_force(docs, corpus, monkeypatch):
    from pitchline.llm import ngram_join
    from pitchline.llm.ngram_join import jaccard_classes

    for k, num, hot in ((4, 85, 14), (3, 60, 14), (3, 60, 1)):
        monkeypatch.setattr(ngram_join, "HOT", hot)  # 1: tokens whose counters hold 4 or more are dealt over tasks
        sets = {}
        for i, t in texts(corpus).items():
            w = W.findall((t or "").translate(LOWER))
            sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
        root = {i: i for i in sets}
        for a in sorted(sets):
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    x, y = sorted((root[a], root[b]))
                    root = {i: x if r == y else r for i, r in root.items()}
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(docs, k, num, bits=12).collect()}
        assert got == {i: (len(s), root[i]) for i, s in sets.items()}
    assert jaccard_classes(docs.limit(0)).count() == 0


def test_ngram_join_equals_its_sql(spark):
    import duckdb

    from pitchline.llm.ngram_join import OP1_SQL, op1_ngram_jaccard_join

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet'")
    want = con.execute(OP1_SQL).fetchall()
    assert sorted(map(tuple, op1_ngram_jaccard_join(spark, d).collect())) == sorted(want) and any(a != c for a, _, c in want)


def test_shared_tokens():
    from pitchline.llm.ngram_join import _shared_only

    rng = np.random.default_rng(1)
    for hot in (0, 3, 14):
        for _ in range(50):
            x = np.sort((rng.integers(1, 6, rng.integers(0, 40)) << 57) | rng.integers(0, 8))
            parts = np.split(x, np.sort(rng.integers(0, len(x) + 1, 4)))
            got = [v for out in _shared_only(hot)(pa.record_batch({"token": pa.array(p, pa.int64())}) for p in parts) for v in out.column(0).to_pylist()]
            assert got == [v for v in x.tolist() if (x == v).sum() > 1 or v >> 57 >= hot]


def test_mixing_meets_targets(spark, docs, corpus):
    from pitchline.llm.mixing import mix_sources

    rows = mix_sources(docs).collect()
    size = {i: len(W.findall(t or "")) for i, t in texts(corpus).items()}
    assert {r.doc_id: r["size"] for r in rows} == size
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
    target = {s: x[0].target for s, x in by.items()}
    total = sum(size.values())
    assert abs(sum(target.values()) - 1.5 * total) < 1e-6
    weight = dict(zip([s for s in sorted(by, key=lambda s: (s is None, s))], [3, 1, 2, 3]))
    free = {s: target[s] / weight[s] for s in by if target[s] < 2 * by[s][0].source_size - 1e-9}
    assert max(free.values(), default=0) - min(free.values(), default=0) < 1e-6
    for s, x in by.items():
        assert abs(sum(r.taken for r in x) - target[s]) <= 40
    assert sorted(rows) == sorted(mix_sources(docs.repartition(2)).collect())
    assert mix_sources(docs.limit(0)).count() == 0


def test_mixing_rates_are_tilted(spark):
    """Rates against a bisection of the dual; a constant rate, which meets the same target, must not come out."""
    from pitchline.llm.mixing import mix_sources, tilts

    rng = random.Random(11)
    kinds = {"grow": 1.3, "shrink": 0.4, "all": 2.0, "same": 1.0}
    sizes = [(k, s, rng.randint(1, 5)) for k in kinds for s in sorted(rng.sample(range(0, 900), 40)) + [20_000]]
    total = {k: sum(s * n for q, s, n in sizes if q == k) for k in kinds}
    sources = spark.createDataFrame([(k, total[k], total[k] * r) for k, r in kinds.items()] + [("none", 0, 0.0)], "key string, source_size long, target double")
    got = {r.key: r for r in tilts(spark.createDataFrame(sizes, "key string, size long, n long"), sources, 2.0).collect()}
    assert set(got) == set(kinds) and got["all"].b is None and abs(got["same"].b) < 1e-8 and got["grow"].b > 1e-3 and got["shrink"].b < -1e-3
    for k in ("grow", "shrink"):
        taken = lambda b: sum(n * s * min(2.0, np.exp(min(b * s / got[k].mean, 700))) for q, s, n in sizes if q == k)  # noqa: B023, E731
        lo, hi = -1e4, 1e4
        for _ in range(200):
            lo, hi = ((lo + hi) / 2, hi) if taken((lo + hi) / 2) < total[k] * kinds[k] else (lo, (lo + hi) / 2)
        assert got[k].b == pytest.approx(lo, abs=1e-6) and taken(got[k].b) == pytest.approx(total[k] * kinds[k], rel=1e-6)
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), src) for i, (n, src) in enumerate((n, s) for s in "ab" for n in (1, 5, 30, 200, 1500, 9000) for _ in range(40))], "doc_id long, text string, source string")
    rate = defaultdict(list)
    for r in mix_sources(docs, weights=(1, 3), share=1.2).collect():
        rate[r.source, r["size"]].append(r.copies)
    mean = {k: sum(v) / len(v) for k, v in rate.items()}
    assert mean["a", 9000] < mean["a", 200] <= mean["a", 5] + 0.05 and mean["b", 9000] > mean["b", 30]


def test_packing_round_trip(docs, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    from pitchline.llm.packing import pack_documents, packed_ids

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = pack_documents(docs, capacity=64)
    got = defaultdict(list)
    for r in rows.collect():
        got[r.sequence_id].append(r)
    for x in got.values():
        at = 0
        for r in sorted(x, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts(corpus).items()}
    seen = {(r.doc_id, r.piece): r for x in got.values() for r in x}
    for i, v in ids.items():
        for k in range(0, len(v), 64):
            r = seen.pop((i, k // 64))
            assert (r.start, r.length, r.ids_crc32) == (k, len(v[k : k + 64]), zlib.crc32(np.array(v[k : k + 64], "<u4").tobytes()))
    assert not seen
    total = sum(r.length for x in got.values() for r in x)
    assert len(got) <= -(-total // 64) + 2
    whole = {r.sequence_id: r.ids for r in packed_ids(docs, rows, 64).collect()}
    assert sum(map(len, whole.values())) == total and max(map(len, whole.values())) <= 64
    assert pack_documents(docs.limit(0)).count() == 0
    assert pack_documents(docs.where("doc_id = 3").unionAll(docs.where("doc_id = 3")), repeats=True).select("copy").distinct().count() == 2


def best_fit_decreasing(lengths, capacity):
    from bisect import bisect_left, insort

    gaps, opened = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect_left(gaps, n)
        if at == len(gaps):
            opened, gap = opened + 1, capacity
        else:
            gap = gaps.pop(at)
        if gap > n:
            insort(gaps, gap - n)
    return opened


def test_packing_against_serial_best_fit(spark, monkeypatch):
    from pitchline.llm import packing

    monkeypatch.setattr(packing, "RANGE_ROWS", 700)  # several ranges, so that ranks decide between them
    rng = random.Random(3)
    mixes = {
        "mixed": [min(4096, max(1, int(rng.lognormvariate(5.5, 1.3)))) for _ in range(6000)],
        "few large, many small": [3000] * 60 + [33] * 5000,
        "no small": [rng.randint(1100, 2500) for _ in range(2000)],
        "ties": [1024] * 900 + [1] * 3000 + [4096] * 5 + [2049] * 300 + [2047] * 300,
        "one": [5],
    }
    for name, lengths in mixes.items():
        df = spark.createDataFrame([(i, n, 0) for i, n in enumerate(lengths)], "doc_id long, length long, part int").repartition(3)
        rows = packing.pack_pieces(df, 4096).collect()
        assert sorted(r.doc_id for r in rows) == list(range(len(lengths)))
        by = defaultdict(list)
        for r in rows:
            by[r.sequence_id].append((r.offset, r.length))
            assert r.length == lengths[r.doc_id] and r.part == 0
        for x in by.values():
            at = 0
            for offset, n in sorted(x):
                assert offset == at
                at += n
            assert at <= 4096
        serial, least = best_fit_decreasing(lengths, 4096), -(-sum(lengths) // 4096)
        assert least <= len(by) <= max(serial + 2, 1.01 * serial), (name, least, serial, len(by))


def rows_made(spark, first, node, *said):
    """Rows that plan nodes with these words made, in all SQL executions from number first on."""
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    for e in range(first, store.executionsCount()):
        nodes, metrics = store.planGraph(e).allNodes(), store.executionMetrics(e)
        for n in (nodes.apply(i) for i in range(nodes.size())):
            if node in n.name() and all(x in n.desc() for x in said):
                own = n.metrics()
                for m in (own.apply(i) for i in range(own.size())):
                    if m.name() == "number of output rows" and metrics.contains(m.accumulatorId()):
                        total += int(metrics.apply(m.accumulatorId()).replace(",", ""))
    return total


def test_packing_makes_what_ranges_leave_once_a_superstep(spark, monkeypatch):
    from pitchline.llm import packing

    monkeypatch.setattr(packing, "RANGE_ROWS", 700)
    left, match = [], packing.Packing.match

    def noted(self, *a):
        out = match(self, *a)
        left.append(out[1])
        assert out[0].count() == out[1]  # one more reading
        return out

    monkeypatch.setattr(packing.Packing, "match", noted)
    for many in (4000, 8000):  # a group of equal lengths, of which gaps of other ranges hold 2,000
        left.clear()
        first = spark._jsparkSession.sharedState().statusStore().executionsCount()
        df = spark.createDataFrame([(i, n) for i, n in enumerate([3000] * 1000 + [400] * many)], "doc_id long, length long").repartition(3)
        assert packing.pack_pieces(df, 4096).count() == 1000 + many
        assert left == [1000, many - 2000]
        assert 0 < rows_made(spark, first, "Join", "rank", ">= done") <= sum(left)


def test_ranges_settle_by_rank():
    from pitchline.llm.packing import settle_ranges

    plan, settled = settle_ranges([(0, 2, 3), (1, 1, 2), (2, 9, 0), (3, 0, 4)])
    assert plan == [(1, 0, 1, 0, 2), (2, 0, 2, 1, 1), (2, 2, 4, 0, 1)] and settled == {0: 0, 1: 1, 2: 4, 3: 0}


def test_encoder_equals_the_library():
    from pitchline.llm.tokens import Encoder

    rng, enc = random.Random(9), Encoder()
    alphabet = "aAzZ éÉñß ªº²¼9 0'sS'T'lLrReEvVmMdD.,!<|>_\t\n\x0b\x1c\x85\xa0Σςİœ漢é̀\U0001f642"
    some = ["".join(rng.choice(alphabet[: rng.choice([20, 45, 99])]) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["x <|endoftext|> y", "don't we're I'M", "", "a" * 500]
    want = [e.ids for e in enc.tok.encode_batch(some, add_special_tokens=False)]
    assert [x.tolist() for x in enc.column(pa.array([*some, None]))] == [*want, []]


def test_token_files(spark, docs, corpus, tmp_path):
    from pitchline.llm.token_files import SLOT, TokenReader, bucket_expr, bucket_of, build_levels, directory, pack_index, read_index, read_token_files, slots_of, write_token_files
    from pitchline.llm.tokens import Encoder

    keys = np.random.default_rng(1).integers(-(2**62), 2**62, 5000)
    levels = directory(build_levels(keys))
    slots = slots_of(keys, levels)
    assert sorted(slots) == list(range(5000))
    again, entries = read_index(pack_index(keys, np.zeros(5000, SLOT)))
    assert (slots_of(keys, again) == slots).all() and len(entries) == 5000
    rows = spark.createDataFrame([(int(k),) for k in keys[:500]], "doc_id long").select("doc_id", bucket_expr("doc_id", 37).alias("b")).collect()
    assert [r.b for r in rows] == bucket_of(np.array([r.doc_id for r in rows]), 37).tolist()
    path, enc, start = f"file://{tmp_path}/t", Encoder(), 0
    write_token_files(docs, path)
    rows = {r.doc_id: r for r in read_token_files(docs.where("doc_id is not null").select("doc_id").distinct(), path).collect()}
    reader = TokenReader(path)
    for i, t in sorted(texts(corpus).items()):
        ids = [*enc.ids(t).tolist(), 2]
        assert reader[i].tolist() == ids
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    with pytest.raises(KeyError):
        reader[1]
    assert write_token_files(docs.limit(0), f"file://{tmp_path}/none")["documents"] == 0


def test_warc_round_trip(spark, tmp_path):
    from pitchline.llm.warc import parse_record, read_records, read_warc, record, write_warc

    big = "ü<p>" * 4000
    pages = spark.createDataFrame([(5, "http://a/\r\nx", big, 1), (2, None, big, 1), (9, "u", "short", 1), (7, "u", "short", 1), (3, "u", None, 1), (4, "u", "", 1), (11, "u", "\r\n\r\n" * 60, 1)], "page_id long, url string, html string, digest int").repartition(3)
    rows = {r.page_id: r for r in read_warc(write_warc(pages, f"file://{tmp_path}/w")).collect()}
    assert len(rows) == 7 and (rows[5].record_type, rows[5].refers_to, rows[2].record_type) == ("revisit", 2, "response")
    assert rows[5].payload_bytes == len(big.encode()) and rows[5].payload_digest == hashlib.sha256(big.encode()).hexdigest()
    assert rows[7].record_type == rows[9].record_type == "response" and rows[3].payload_bytes == 0 and rows[11].payload_bytes == 240
    assert read_warc(write_warc(pages.limit(0), f"file://{tmp_path}/e")).count() == 0
    one = record(1, "u", b"x" * 9, None, "2024-01-01T00:00:00Z")
    assert [parse_record(*r)[5] for r in read_records(io.BytesIO(one + one), 7)] == [b"x" * 9] * 2
    bad = gzip.compress(gzip.decompress(one).replace(b"xxx", b"yyy"))
    with pytest.raises(ValueError):
        [parse_record(*r) for r in read_records(io.BytesIO(bad))]
    with pytest.raises(ValueError):
        list(read_records(io.BytesIO(one[:-20])))


def brute_anchors(text, k=3, s=1):
    """(first word, hash) of each anchor, by the rule and XXH64 with chained seeds."""
    import xxhash

    long_ = lambda x, seed: xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed)
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in W.findall(text)]

    def chain(xs):
        out = 42
        for x in xs:
            out = long_(x, out)
        return out

    signed = lambda x: x - 2**64 if x >= 2**63 else x
    out, last = [], None
    for i in range(len(h) - k + 1):
        runs = [signed(chain(h[j : j + s])) for j in range(i, i + k - s + 1)]
        if min(runs) in (runs[0], runs[-1]):
            gap = 0 if last is None else i - last
            out.append((i, xxhash.xxh64_intdigest(gap.to_bytes(4, "little"), chain(h[i : i + k]))))
            last = i
    return out or ([(0, chain(h))] if h else [])


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_syncmers_equal_brute_force(spark, docs, corpus):
    from pitchline.llm.syncmers import _shift, anchors, fingerprints

    t = {i: x or "" for i, x in texts(corpus).items()}
    rng = random.Random(9)
    vast = " ".join(f"w{rng.randrange(10**6)}" for _ in range(30_000))
    odd = spark.createDataFrame([(2**40, vast, 1, 1, 1), (2**40 + 1, vast + " end", 1, 1, 1), (-(2**50), " \n\tA\u0085 b\x0bc ", 1, 1, 1)], "doc_id long, text string, group int, ghost int, after int")
    both = docs.select("doc_id", "text", F.lit(1).alias("group"), F.lit(1).alias("ghost"), F.lit(1).alias("after")).unionAll(odd)
    t |= {r.doc_id: r.text for r in odd.collect()}
    rows = {r.doc_id: r for r in fingerprints(both).collect()}
    ids, made = sorted(t), {r.doc_id: r.anchors for r in anchors(both).collect()}
    assert sorted(rows) == ids
    own = {i: brute_anchors(t[i]) for i in ids}
    digits = lambda a: "".join(f"{x:016x}" for x in dict.fromkeys(x for _, x in a))
    for n, i in enumerate(ids):
        after = ids[(n + 1) % len(ids)]
        q = len(t[i]) // 4
        edited = t[i][: len(t[i]) - q] + t[after][:q]
        e = brute_anchors(edited)
        assert (rows[i].n_chars, rows[i].edited_sha256) == (len(t[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert (rows[i].fingerprint, rows[i].edited_fingerprint) == (digits(own[i]), digits(e))
        assert [(x["at"], x["hash"] % 2**64) for x in made[i]] == own[i]
        hashes = lambda a: {x for _, x in a}
        assert rows[i].near_edited == pytest.approx(jaccard(hashes(own[i]), hashes(e)))
        assert rows[i].near_next == pytest.approx(jaccard(hashes(own[i]), hashes(own[after])))
    assert len(own[2**40]) > 15_000 and rows[2**40].near_next > 0.99
    assert fingerprints(docs.limit(0)).count() == 0
    alone = fingerprints(docs.where("doc_id = 3")).first()
    assert alone.near_next == 1.0
    for step in (1, 7, 2**33):
        few = spark.range(3000).select((F.col("id") * step).alias("doc_id"))
        few = few.union(spark.createDataFrame([(2**60,), (-(2**61),)], "doc_id long")) if step == 7 else few
        assert few.groupBy(F.shiftright("doc_id", _shift(few))).count().agg(F.max("count")).first()[0] <= 256


def test_syncmers_match_by_position():
    a = [f"w{i}" for i in range(60)]
    moved = a[:20] + ["new", "words"] + a[20:]  # an insertion costs the anchors around it alone
    x, y = ({h for _, h in brute_anchors(" ".join(w))} for w in (a, moved))
    assert jaccard(x, y) > 0.85
    thinned = [w for i, w in enumerate(a) if i % 10]  # k-mers that are left, at other distances, are no matches
    kmers = lambda w: {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    assert jaccard(x, {h for _, h in brute_anchors(" ".join(thinned))}) < jaccard(kmers(a), kmers(thinned))


def test_line_dedup(spark, docs, corpus):
    from pitchline.llm.line_dedup import dedup_lines

    rows = [(0, "common\nown 0\n\ncommon ", "a"), (1, "x\n common", "b"), (2, "common", "c"), (3, None, "a"), (4, "", None), (5, "two\ntwo", "a"), (6, "two", "b"), (7, "two", None)]
    df = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, source string, out int, at int").repartition(3)
    got = {r.doc_id: (r.clean_text, r.n_lines, r.n_removed) for r in dedup_lines(df).collect()}
    assert got[0] == ("common\nown 0\n", 3, 1) and got[1] == ("x", 2, 1) and got[2] == ("", 1, 1)
    assert got[3] == (None, 0, 0) and got[5] == ("two\ntwo", 2, 0) and got[7] == ("two", 1, 0)
    wide = spark.createDataFrame([(i, "everywhere", f"site{i % 90}") for i in range(400)], "doc_id long, text string, source string")
    assert dedup_lines(wide, sites=50).where("n_removed = 1").count() == 399
    assert dedup_lines(wide, sites=91).where("n_removed = 1").count() == 0
    assert dedup_lines(df.limit(0)).count() == 0
    # a very long text, in linear time; white space that Java's $ would step over; lines of few words kept; names that clash
    many = [f"line {i}" for i in range(100_000)]
    rows = [(0, "\n".join(many), "a", 1), (1, "\n".join(many), "b", 2), (2, "\n".join([*many, "own \x85", "own \x85 "]), "c", 3)]
    wide = spark.createDataFrame(rows, "doc_id long, text string, source string, at int").withColumns({"all": F.lit(1), "carried": F.lit(2), "estimate": F.lit(3)})
    got = {r.doc_id: r for r in dedup_lines(wide, carry=("at", "all", "carried", "estimate")).collect()}
    assert (got[0].n_removed, got[1].n_removed, got[2].n_removed, got[2].n_lines) == (0, 100_000, 100_000, 100_002)
    assert got[2].clean_text == "own \x85\nown \x85 " and got[0].clean_text == rows[0][1] and (got[2].at, got[2]["all"], got[2].carried, got[2].estimate) == (3, 1, 2, 3)
    assert dedup_lines(wide, least_words=3).where("n_removed > 0").count() == 0


def test_line_dedup_decides_by_sketches_beyond_the_band(spark):
    from pyspark.sql.functions import hll_sketch_estimate  # noqa: F401

    from pitchline.llm.line_dedup import _lines, band, spread

    rng = random.Random(8)
    spread_of = {f"line {n} {i}": n for n in (1, 2, 3, 4, 5, 9, 40, 70, 100, 130, 400) for i in range(5)}
    rows = [(k, f"site{j}") for k, n in spread_of.items() for j in rng.sample(range(500), n) for _ in range(1 + (j == 3))]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, s) for i, (t, s) in enumerate(rows)], "doc_id long, text string, source string")
    lines = _lines(docs, 1).cache()
    firsts = {}
    for i, (t, _) in enumerate(rows):
        firsts.setdefault(t, i)
    for sites in (1, 3, 4, 100):
        got = {r.first_doc for r in spread(lines, sites).collect()}
        assert got == {firsts[t] for t, n in spread_of.items() if n >= sites}
    assert band(3, 8) == 1 and band(100, 8) == 26


def test_importance_resampling(spark, docs, corpus):
    from pitchline.llm.importance import largest, resample

    good = spark.createDataFrame([(i * 3,) for i in range(0, 60, 2)] + [(None,)], "doc_id long")
    rows = resample(docs, good, 0.3).collect()
    assert len(rows) == len(texts(corpus)) and sum(r.selected for r in rows) == round(0.3 * len(rows))
    assert min(r.gumbel_key for r in rows if r.selected) >= max(r.gumbel_key for r in rows if not r.selected)
    assert resample(docs.limit(0), good).count() == 0
    ties = spark.range(50_000).selectExpr("cast(id % 2 as double) as v", "id")
    assert largest(ties, "v", "id", 25_010) == (0.0, 18)
    assert largest(ties, "v", "id", 30) == (1.0, 59)


def test_importance_weights_equal_brute_force(spark, docs, corpus):
    """Counts, ratios and weights again in plain Python; only the two hash functions are the operator's."""
    from pitchline.llm.common import U, mix, word_hashes
    from pitchline.llm.importance import resample

    bits, long_ = 9, " ".join(f"tail{i % 700}" for i in range(20_000))
    t = texts(corpus) | {9000: long_, 9003: long_}
    more = spark.createDataFrame([(9000, long_, "s1", 7, 1, 1), (9003, long_, None, 7, 1, 1)], docs.schema)
    good = {*range(0, 120, 6), 9000}

    def grams(text):
        w = [int(word_hashes(np.frombuffer(x.encode(), np.uint8), np.array([0]), np.array([len(x.encode())]), cased=True)[0]) for x in W.findall(text or "")]
        two = [int(mix(np.array([(a * 0xA24BAED4963EE407 + b) % 2**64], np.uint64))[0]) for a, b in zip(w, w[1:])]
        return [x >> (64 - bits) for x in w + two]

    of = {i: grams(x) for i, x in t.items()}
    raw, aim = np.ones(1 << bits), np.ones(1 << bits)
    for i, g in of.items():
        for x in g:
            raw[x] += 1
            aim[x] += i in good
    ratio = np.log(aim / aim.sum()) - np.log(raw / raw.sum())
    target = spark.createDataFrame([(i,) for i in good] + [(0,), (777_777,)], "doc_id long")
    rows = {r.doc_id: r for r in resample(docs.unionAll(more), target, 0.4, bits=bits).collect()}
    assert sorted(rows) == sorted(t)
    for i, g in of.items():
        assert rows[i].log_weight == pytest.approx(sum(ratio[x] for x in g), rel=1e-9, abs=1e-9)
    assert rows[9000].log_weight == rows[9003].log_weight and rows[9000].gumbel_key != rows[9003].gumbel_key
    order = sorted(rows.values(), key=lambda r: (-r.gumbel_key, r.doc_id))
    assert {r.doc_id for r in rows.values() if r.selected} == {r.doc_id for r in order[: round(0.4 * len(rows))]}
    noise = [r.gumbel_key - r.log_weight for r in resample(spark.range(4000).selectExpr("id as doc_id", "'' as text"), target).collect()]
    assert abs(np.mean(noise) - 0.5772) < 0.08 and abs(np.var(noise) - np.pi**2 / 6) < 0.2
    assert U(1) and {r.log_weight for r in resample(docs, target.limit(0)).collect()} == {0.0}


def test_nearest_neighbours(spark):
    from pitchline.llm.ann import search

    rng = np.random.default_rng(2)
    centers = rng.normal(size=(30, 16)) * 3
    x = centers[rng.integers(0, 30, 2000)] + rng.normal(size=(2000, 16))
    x[100:140] = x[100]
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x.astype(np.float32))]
    odd = [(5000, None, 0), (5100, [0.0] * 16, 0), (5200, [float("nan")] * 16, 0), (5300, [None] * 16, 0), (5400, [1.0], 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int")
    got = defaultdict(list)
    for r in search(df, F.col("vec_id") % 100 == 0, lists=16, probes=6).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 2000, 100))
    y, hit = x.astype(np.float32).astype(float), 0
    for q, found in got.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((np.arange(2000), d))[:10]
        hit += len(set(best) & {v for v, _ in found})
        assert all(abs(d[v] - s) < 1e-9 for v, s in found) and [s for _, s in found] == sorted(s for _, s in found)
    assert hit >= 0.9 * 200
    assert [v for v, _ in got[100]] == list(range(101, 111))
    assert search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_nearest_neighbours_in_large_groups_of_near_copies(spark):
    from pitchline.llm.ann import search

    rng = np.random.default_rng(3)
    unit = lambda z: z / np.linalg.norm(z, axis=1, keepdims=True)
    group = np.repeat(np.arange(24), [50] * 20 + [200] * 2 + [1000] * 2)
    x = unit(rng.normal(size=(24, 64)))[group]
    x = np.concatenate([x + rng.normal(size=x.shape) * 0.03 / 64**0.5, unit(rng.normal(size=(4000, 64)))])
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in search(df, F.col("vec_id") % 100 == 0, lists=8, probes=8).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert sorted(got) == list(range(0, len(x), 100))
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        assert found == np.argsort(d)[:10].tolist()


def test_nearest_neighbours_with_default_settings(spark, monkeypatch):
    """Recall without clusters and with them, each with as many lists probed as was measured; ties over blocks go to smaller ids."""
    from pitchline.llm import ann

    monkeypatch.setattr(ann, "BLOCK", 100)
    rng = np.random.default_rng(7)
    loose = rng.normal(size=(3000, 32))
    tight = (rng.normal(size=(60, 32)) * 8)[rng.integers(0, 60, 3000)] + rng.normal(size=(3000, 32))
    tight[500:540] = tight[500]  # 40 equal vectors, dealt over several blocks of a list
    probed = {}
    for name, x in (("loose", loose), ("tight", tight)):
        codec = ann.Codec(x, int(len(x) ** 0.5 / 2))
        probed[name] = ann.measured_probes(codec, x, 10)
        df = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        got = defaultdict(list)
        for r in ann.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
            got[r.query_id].append(r.vec_id)
        hit = 0
        for q in range(0, 3000, 100):
            d = np.sqrt(((x - x[q]) ** 2).sum(1))
            d[q] = np.inf
            hit += len(set(np.lexsort((np.arange(3000), d))[:10].tolist()) & set(got[q]))
        assert sorted(got) == list(range(0, 3000, 100)) and hit >= 0.93 * 300, (name, hit)
        if name == "tight":
            assert got[500] == list(range(501, 511))
    assert probed["tight"] < probed["loose"]


def test_toxicity(spark):
    from pitchline.llm.toxicity import HIDDEN, Net, _sigmoid, score_documents, train

    rng = random.Random(5)
    clean = [" ".join(words(rng, rng.randint(5, 200))) for _ in range(150)]
    bad = [" ".join(w if rng.random() > 0.05 else rng.choice(["Vile", "rotten", "awful"]) for w in [*words(rng, rng.randint(40, 200)), "vile"]) for _ in range(80)]
    net = train(clean[:100] + bad[:50], np.array([0] * 100 + [1] * 50))
    s = net.scores(pa.array([*bad[50:], *clean[100:], "", None, " "]))
    hit = (s[:30] >= 0.3).mean(), (s[30:80] >= 0.3).mean()
    assert hit[0] >= 0.9 and hit[1] <= 0.1 and (s[80:] == 0).all()
    far = " ".join([*words(rng, 4000), "vile", "rotten", "vile", *words(rng, 4000)])
    assert net.scores(pa.array([far]))[0] == pytest.approx(net.scores(pa.array([far + " "]))[0])
    df = spark.createDataFrame([(1, bad[60], 3), (1, None, 3), (None, clean[120], 3)], "doc_id long, text string, score int")
    assert score_documents(df, net, "p").where("p >= 0.3").count() == 1
    assert (train(clean, np.zeros(150)).scores(pa.array(bad)) < 0.3).all()
    # gradients against differences
    g = np.random.default_rng(0)
    n = Net(np.zeros(0, np.uint64), np.zeros(0, np.float32))
    n.p = {k: v.astype(np.float64) for k, v in n.p.items()}
    x, at, mask = g.normal(size=(6, n.p["Wf"].shape[0])), g.integers(0, 6, (3, 5)), np.ones((3, 5))
    mask[1, 3:] = 0
    loss = lambda: np.log(1 + np.exp(n.forward(x, at, mask))).sum()
    logit, kept = n.forward(x, at, mask, True)
    grads, dx = n.backward(x, at, mask, kept, _sigmoid(logit))
    for name in ("Wf", "Ub", "A", "o"):
        i = tuple(d // 2 for d in n.p[name].shape)
        old = n.p[name][i]
        n.p[name][i] = old + 1e-5
        up = loss()
        n.p[name][i] = old - 1e-5
        down = loss()
        n.p[name][i] = old
        assert abs((up - down) / 2e-5 - grads[name][i]) < 1e-4
    assert HIDDEN and dx.shape == x.shape


def test_pipeline_stages(spark):
    import corpus_pipeline as c

    d = "/root/testdata/sf0.001"
    before = spark.read.parquet(f"{d}/documents.parquet")
    assert [n for n, _ in c.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "mixing", "best_fit_packing"]
    packed = c.run(spark, d)
    assert packed.count() > 0 and packed.join(before, "doc_id", "left_anti").count() == 0


@pytest.fixture(scope="module")
def odd_documents(spark):
    """Nulls in all columns, empty and repeated rows, ties, a long text, and names that the stages might use themselves."""
    rng = random.Random(6)
    long_ = "\n".join(" ".join(words(rng, 12)) for _ in range(3000))
    stock = "this line of seven words stands everywhere"
    some = [" ".join(words(rng, 40)) for _ in range(12)]
    rows = [(i, t, s) for i, (t, s) in enumerate([*zip(some, "abcabcabcabc"), (some[0], "b"), (some[0] + " end", "c"), (None, "a"), ("", None), ("  ", "b"), (long_, "c"), (long_, None)])]
    rows += [(30 + i, f"{some[i]} own {i}\n{stock}\nshort one", "abc"[i % 3]) for i in range(6)] + [(40, stock, "a"), (None, some[3], "a"), (0, some[0], "a"), (0, "z", "a"), (None, None, None)]
    names = ["out", "n_lines", "clean_text", "rest", "_copies", "copies", "_toxicity", "toxicity", "rank", "size", "key", "rid", "piece", "n"]
    df = spark.createDataFrame([(*r, None if r[0] is None else len(r[1] or "")) for r in rows], "doc_id long, text string, source string, n_chars int")
    return df.withColumns({x: F.lit(i) for i, x in enumerate(names)}).withColumn("tags", F.create_map(F.lit("a"), F.lit(1))).repartition(3)


def test_pipeline_stages_on_odd_rows(spark, odd_documents, monkeypatch):
    import corpus_pipeline as c
    from pitchline.llm import toxicity

    net = toxicity.Net(np.zeros(0, np.uint64), np.zeros(0, np.float32))
    net.shift = 1e9  # nothing is toxic
    monkeypatch.setattr(c, "fit", lambda docs, labels: net)
    d, df = "/root/testdata/sf0.001", odd_documents
    key = lambda x: sorted(map(str, x))
    plain = lambda x: [(r.doc_id, r.text, r.source) for r in x.collect()]
    assert key(plain(c.drop_toxic(spark, df, d))) == key(plain(df))
    chosen = {}
    for i, t, s in sorted(plain(df), key=lambda r: (r[1] is not None, r[1] or "", r[2] is not None, r[2] or "")):
        if i is not None:
            chosen.setdefault(i, (t, s))
    # line dedup, by brute force
    held, first = defaultdict(set), {}
    for i in sorted(chosen):
        for at, line in enumerate((chosen[i][0] or "").split("\n")):
            if len(W.findall(line)) >= 5:
                first.setdefault(line.strip(), (i, at))
                if chosen[i][1] is not None:
                    held[line.strip()].add(chosen[i][1])
    want = {}
    for i, (t, s) in chosen.items():
        lines = (t or "").split("\n")
        kept = [x for at, x in enumerate(lines) if len(held[x.strip()]) < 3 or first[x.strip()] == (i, at)]
        if kept or not t:
            want[i] = (None if t is None else "\n".join(kept), s)
    got = c.drop_boilerplate(spark, df, d)
    assert got.columns == df.columns and {r.doc_id: (r.text, r.source) for r in got.collect()} == want and got.count() == len(want)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.rest == 3 and r.tags == {"a": 1} for r in got.collect())
    # near copies, by brute force
    sets = {i: (lambda w: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set()))(W.findall((t or "").translate(LOWER))) for i, (t, _) in chosen.items()}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root[a], root[b]))
                root = {i: x if r == y else r for i, r in root.items()}
    got = c.drop_near_copies(spark, df, d)
    assert got.columns == df.columns and key(plain(got)) == key((i, *chosen[i]) for i in chosen if root[i] == i)
    # mixing: each row as often as the operator says
    from pitchline.llm.mixing import mix_sources

    copies = {r.doc_id: r.copies for r in mix_sources(df).collect()}
    got = c.mix(spark, df, d)
    assert got.columns == df.columns and key(plain(got)) == key((i, *chosen[i]) for i in chosen for _ in range(copies[i]))
    # packing: all copies, each token once
    from pitchline.llm.tokens import Encoder

    enc, packed = Encoder(), c.pack(spark, df, d)
    total = defaultdict(int)
    for r in packed.collect():
        total[r.doc_id] += r.length
    want = defaultdict(int)
    for i, t, _ in plain(df):
        if i is not None:
            want[i] += len(enc.ids(t)) + 1
    assert total == want
    none = df.limit(0)
    for _, stage in c.STAGES:
        assert stage(spark, none, d).count() == 0
