"""Operators 11 to 13 against plain versions, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievework.llm import fim, periodic, queries, recompress


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_elias_fano():
    rng = random.Random(1)
    for n, top in ((1, 1), (1, 900), (7, 7), (50, 51), (50, 400), (300, 100_000)):
        values = np.array(sorted(rng.sample(range(top), n)), dtype=np.int64)
        code = fim.encode(values, top)
        assert fim.select(code, n, np.arange(n)).tolist() == values.tolist()
        assert len(code) <= 4 + n * (3 + max(0, (top // n).bit_length() - 1)) / 8


def plain_cut(doc_id, text):
    text = text or ""
    n = len(text)
    h = [int(sha(f"1:{doc_id}".encode())[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if doc_id is None or not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


@pytest.mark.parametrize("part_rows", [4096, 2])
def test_fill_in_middle(spark, monkeypatch, part_rows):
    monkeypatch.setattr(fim, "PART_ROWS", part_rows)
    rng = random.Random(5)
    pool = ["a", "é", "漢", "𝄞", " ", "\n", "<", "P", "S", "M", ">", "́", "\x00"]
    copy = "".join(rng.choice(pool[:6]) for _ in range(40))
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for i in range(200)] + [(1000 + i, copy) for i in range(50)]
    rows += [(2000, None), (2001, ""), (2002, "a<S>b"), (None, "no id"), (2003, "x" * 300_000), (2004, "same"), (2004, "same"), (2004, "other")]
    d = spark.createDataFrame([(*r, 1, "psm") for r in rows], "doc_id long, text string, n int, form string").repartition(3)
    got = fim.transform(d).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(repr, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, bytes(r.output).decode()) for r in got))) == sorted(repr((i, *plain_cut(i, t))) for i, t in rows)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    assert fim.transform(d.limit(0)).count() == 0


def test_fill_in_middle_of_other_bytes(spark):
    """Texts that aren't UTF-8 are cut and restored byte by byte."""
    d = spark.range(40).select(F.col("id").alias("doc_id"), F.expr("cast(concat(X'80C3', cast(repeat('ab', int(id)) as binary), X'FFC3A9') as string)").alias("text"))
    rows = fim.transform(d).select("doc_id", "form", fim.restored(F.col("output"), F.col("form")).cast("binary").alias("back")).collect()
    assert all(bytes(r.back) == b"\x80\xc3" + b"ab" * r.doc_id + b"\xff\xc3\xa9" for r in rows) and {r.form for r in rows} == {"plain", "psm", "spm"}


def plain_runs(w):
    n, found = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def odd_words(rng):
    w = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 40))]
    if rng.random() < 0.5 and w:
        u = w[: rng.randint(1, 8)]
        w = w[: rng.randint(0, len(w))] + u * rng.randint(1, 9) + u[: rng.randint(0, len(u))] + w[:5]
    return w


@pytest.mark.parametrize("at_once", [5, 1 << 20])
def test_runs_equal_brute_force(monkeypatch, at_once):
    monkeypatch.setattr(periodic, "AT_ONCE", at_once)
    rng = random.Random(at_once)
    for _ in range(300):
        docs = [odd_words(rng) for _ in range(rng.randint(1, 5))]
        sizes, runs, kept = periodic._batch([" ".join(d).encode() for d in docs])
        assert sizes == [len(d) for d in docs] and runs == [plain_runs(d) for d in docs]
        for d, own, rest in zip(docs, runs, kept):
            gone = {i for s, n, p in own for i in range(s + p, s + n)}
            assert rest == " ".join(x for i, x in enumerate(d) if i not in gone).encode()


def test_extensions():
    """Prefixes longer than what is compared word by word, in both branches, against plain comparison."""
    rng = np.random.default_rng(3)
    unit = rng.integers(0, 50, 300)
    words = np.concatenate([unit, [99], unit, [98], unit[:200], rng.integers(0, 3, 200), unit[150:]])
    e = periodic.Extensions(words, np.full(len(words), len(words)))
    a = rng.integers(0, len(words), 3000)
    b = rng.integers(0, len(words), 3000)
    a, b = np.append(a[a != b], [0, 0, 301]), np.append(b[a != b], [301, 602, 602])
    for x, y, n in zip(a.tolist(), b.tolist(), e(a, b).tolist()):
        most = len(words) - max(x, y)
        differ = np.flatnonzero(words[x : x + most] != words[y : y + most])
        assert n == (differ[0] if len(differ) else most)
    values = rng.integers(0, 1000, 1000).astype(np.int32)
    least = periodic.RangeMinimum(values)
    a = rng.integers(0, 1000, 2000)
    b = np.minimum(a + rng.integers(0, 1000, 2000), 999)
    assert least(a, b).tolist() == [values[x : y + 1].min() for x, y in zip(a, b)]


def plain_op11(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = plain_runs(w)
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    s, k, p = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    said = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return doc_id, len(runs), s, k, p, 1000 * k // p if runs else None, sha(said.encode()), sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode())


def test_periodic_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " \n".join(odd_words(rng))) for i in range(300)] + [(300, None), (301, ""), (302, " \t"), (303, "a " * 3000), (304, "é 漢\x00 " * 9), (305, "b " * 6), (305, "b " * 6), (306, "b " * 5)]
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_runs int").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect())
    assert got == sorted((plain_op11(*r) for r in rows))
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 10


def test_runs_of_odd_rows(spark):
    rows = [(None, "a " * 8), (1, None), (2, "x y " * 5)]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, runs string")
    got = {r.doc_id: r for r in periodic.runs(d).collect()}
    assert [tuple(x) for x in got[None].runs] == [(0, 8, 1)] and bytes(got[None].kept) == b"a"
    assert got[1].runs == [] and got[1].n_words == 0 and bytes(got[1].kept) == b""
    assert [tuple(x) for x in got[2].runs] == [(0, 10, 2)] and bytes(got[2].kept) == b"x y"
    assert periodic.runs(d.limit(0)).count() == 0
    bytes_only = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("cast(repeat(cast(X'FF20' as string), 7) as string)").alias("text"))
    assert [tuple(x) for x in periodic.runs(bytes_only).first().runs] == [(0, 7, 1)]


def plain_windows(docs, n):
    """{(id, text): starts of windows that also start earlier}; rows with one id and text are one document."""
    first, out = {}, {}
    for i, text in sorted({(i, t or "") for i, t in docs if i is not None}):
        w = text.encode().split()
        own = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
        out[i, text] = [k for k, x in enumerate(own) if first.setdefault(x, (i, text, k)) != (i, text, k)]
    return out


def test_symbols_hang_on_their_context():
    """Each interior symbol of a window is there wherever the window stands, at any level; names of different words differ."""
    rng = random.Random(4)
    core = [rng.choice(["a", "a", "b", "c%d" % rng.randint(0, 9)]) for _ in range(60)]
    texts = [" ".join([rng.choice("abc") for _ in range(rng.randint(0, 9))] + core + [rng.choice("abc") for _ in range(rng.randint(0, 9))]).encode() for _ in range(20)] + [b"", b"a"]
    words = recompress.Words(texts)
    at = [next(k for k in range(len(w)) if w[k : k + 60] == [c.encode() for c in core]) for w in words.lists[:20]]
    seen = 0
    for _, s in recompress.levels(words, 6):
        for start in range(0, 40):
            found = []
            for d, a in enumerate(at):
                x = int(words.begin[np.searchsorted(words.doc, d)]) + a + start
                inner = (s.low >= x) & (s.high <= x + recompress.WINDOW)
                found.append([(int(n), int(p) - x) for n, p in zip(s.name[inner], s.at[inner])])
            assert all(f == found[0] for f in found)
            seen += len(found[0])
        assert (np.diff(s.low) >= 0).all() and (np.diff(s.high) >= 0).all()
    assert seen > 500


@pytest.mark.parametrize(("slice_bytes", "hot_rows"), [(64, 1 << 20), (1 << 20, 1 << 20), (64, 2)])
def test_recompression_equals_brute_force(spark, monkeypatch, slice_bytes, hot_rows):
    monkeypatch.setattr(recompress, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(recompress, "HOT_ROWS", hot_rows)
    rng = random.Random(9)
    pool = ["w%d" % i for i in range(300)]
    text = lambda n: [rng.choice(pool) for _ in range(n)]
    passages = [text(rng.randint(18, 90)) for _ in range(5)] + [["a"] * 45, ["a", "b"] * 30, ["a", "b", "c"] * 21]
    rows = []
    for i in range(120):
        w = text(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 10)
            w += p[a : len(p) - rng.randint(0, 10)] + text(rng.randint(0, 25))
        rows.append((i, " ".join(w)))
    rows += [(200, rows[5][1]), (201, rows[5][1]), (201, rows[5][1]), (202, None), (203, ""), (204, "x\ty\nz"), (None, rows[5][1]), (205, "q " * 3000), (206, " ".join(text(5000)))]
    # one id, different texts: what is alone stays
    one, other = " ".join(text(40)), " ".join(text(200))
    rows += [(300, one), (301, " ".join(text(60)) + " " + one), (301, other)]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, spans string").repartition(4)
    got = recompress.remove_repeats(d).collect()
    expected = plain_windows(rows, recompress.WINDOW)
    want = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = {k + j for k in expected.get((i, t or ""), ()) for j in range(recompress.WINDOW)}
        want.append((repr(i), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    assert sorted((repr(r.doc_id), r.n_words, sum(s.end - s.start for s in r.spans), bytes(r.kept)) for r in got) == sorted(want)
    assert other.encode() in {bytes(r.kept) for r in got if r.doc_id == 301}
    assert recompress.remove_repeats(d.limit(0)).count() == 0
