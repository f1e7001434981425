"""Text operators against plain versions, and on odd rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievework.llm import bpe, components, jaccard, langid, license, packing, queries, suffix, tokenfile, toxicity
from sievework.llm.components import connected_components, forest
from sievework.llm.tokens import CachedTokenizer

RANKS, BYTES, WORDS, PIECES = (P.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
random.seed(11)
VOCABULARY = ["w%d" % i for i in range(60)]


def words(n):
    return " ".join(random.choice(VOCABULARY) for _ in range(n))


BASE, LONG = words(80), words(30_000)
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "A  B\n"), (6, BASE), (7, BASE), (8, BASE + " tail"), (9, LONG), (10, "éÀ漢字 ﷽ \x00 'S it's"), (11, "123 456! ½ ²"), (12, "x" * 5000), (12, "x" * 5000), (13, BASE.upper()), (14, "a <|endoftext|> b")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", 0.5, 1) for i, t in ODD], "doc_id long, text string, lang string, score double, n int").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def samples(n=3000):
    pool = list(" \n\t  'stmdrevl1a٣b漢Z!.  \x1c\x85éÉΣ") + ["'s", "'re", "  ", " '", "<|endoftext|>", "́", "ab", " cd", "e. "]
    rng = random.Random(4)
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_bpe_equals_tiktoken():
    import tiktoken

    c = bpe.Codec(RANKS)
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=c.ranks, special_tokens={})
    texts = samples() + ["", "a" * 300, "é" * 80]
    ids, ends, offsets = c.encode([t.encode() for t in texts])
    at = 0
    for t, end in zip(texts, ends.tolist()):
        own = ids[at:end]
        assert own.tolist() == e.encode_ordinary(t), repr(t)
        assert c.decode(own) == t.encode() == c.decode(own, offsets[at:end]) and (not len(own) or offsets[end - 1] == len(t.encode()))
        at = end
    for piece in (b"thableness", b"zzqqxx", b"x" * 70):
        assert bpe.merge_piece(piece, c.ranks) == e._encode_single_piece(piece)


def test_scan_crosses_blocks():
    """Pieces of one long text, whose states pass through many blocks, equal those of the pattern."""
    import regex

    rng = random.Random(12)
    text = "".join(rng.choice(["ab", "1", " ", "  ", "\n", "'s", "'ll", "'", "!", "é", "漢" * 300, "." * 400, " " * 300]) for _ in range(4000))
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    assert bpe.piece_starts(points, np.zeros(1, dtype=np.int64)).tolist() == [m.start() for m in regex.finditer(P.PATTERN, text)]


def test_bpe_operator(spark, odd, none):
    rows = {(r.doc_id, r.n_tokens, r.ids_sha256): r.decoded_sha256 for r in bpe.digests(odd, RANKS).collect()}
    want = {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD}
    assert {(k[0], v) for k, v in rows.items()} == want and bpe.digests(none, RANKS).count() == 0
    assert [k[1] for k in rows if k[0] in (1, 2)] == [0, 0]
    coded = bpe.encode(odd, RANKS)
    for placed in ("offsets", None):
        assert sorted((r.doc_id, bytes(r.decoded)) for r in bpe.decode(coded, RANKS, offsets_col=placed).collect()) == sorted((i, (t or "").encode()) for i, t in ODD)


@pytest.mark.parametrize("path,drops", [(BYTES, False), (WORDS, True)])
def test_cached_tokenizer_equals_library(path, drops):
    c, texts = CachedTokenizer(path, drops), samples(2000) + ["Word, word. word's!! x***\ny"]
    library = Tokenizer.from_file(path)  # as it is, which makes special tokens of their strings
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):  # cold and warm
        ids, ends = c.encode([t.encode() for t in texts])
        got = np.split(ids, ends[:-1])
        assert [g.tolist() for g in got] == want
    c = CachedTokenizer(path, drops)
    c.inner.numbers.most = c.outer.numbers.most = 50
    ids, ends = c.encode([t.encode() for t in texts])
    assert [g.tolist() for g in np.split(ids, ends[:-1])] == want and len(c.outer.numbers) == 50
    assert any(library.token_to_id("<|endoftext|>") in x for x in want)


def test_token_files(spark, odd, none, tmp_path):
    import pyarrow.parquet as pq

    out = str(tmp_path / "t")
    tokenfile.write_tokens(odd, BYTES, out)
    rows = sorted(tokenfile.checksums(tokenfile.read_tokens(spark, out)).collect(), key=lambda r: r.start)
    t = Tokenizer.from_file(BYTES)
    at = 0
    for r, (i, text) in zip(rows, sorted(ODD, key=lambda x: x[0])):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    f = next((tmp_path / "t").glob("*.parquet"))
    column = pq.ParquetFile(f).metadata.row_group(0).column(1)
    assert column.path_in_schema.startswith("ids") and column.has_column_index and column.has_offset_index and "RLE_DICTIONARY" in column.encodings
    tokenfile.write_tokens(none, BYTES, str(tmp_path / "n"))
    assert tokenfile.checksums(tokenfile.read_tokens(spark, str(tmp_path / "n"))).count() == 0


def test_packing_plan():
    rng = random.Random(5)
    for capacity in (12, 100, 2048):
        for _ in range(5):
            h = {n: rng.randint(1, 9) for n in rng.sample(range(1, capacity + 1), min(capacity, 60))}
            places: dict[int, list] = {}
            for n, lo, k, m, first, at in packing.plan(h, capacity):
                for i in range(m):
                    places.setdefault(first + i, []).extend((at + j * n, n) for j in range(k))
            assert sum(map(len, places.values())) == sum(h.values())
            for own in places.values():
                own.sort()
                assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= capacity
                assert sum(3 * n > capacity for _, n in own) <= 2
            low = -(-sum(n * c for n, c in h.items()) // capacity)
            assert len(places) <= 1.3 * low + 2
    assert packing.plan({}, 10) == []


def test_packing_operator(spark, odd, none):
    rows = packing.pack_documents(odd, WORDS, capacity=64).collect()
    t = Tokenizer.from_file(WORDS)
    for (i, text), n in {x: ODD.count(x) for x in ODD}.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i)
        want = [(p, a, len(ids[a : a + 64]), zlib.crc32(np.array(ids[a : a + 64], dtype="<u4").tobytes())) for p, a in enumerate(range(0, len(ids), 64))]
        assert own == sorted(want * n)
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 64
    assert packing.pack_documents(none, WORDS).count() == 0


def test_language(spark, odd, none):
    assert langid.Pieces(["▁a", "b"]).lattice(["▁ab"]).piece.tolist().count(-1) == 2
    docs = spark.createDataFrame([(i, ("the cat and the dog " if i % 2 else "le chat et le chien ") * (1 + i % 5), "en" if i % 2 else "fr") for i in range(60)], "doc_id long, text string, lang string")
    model = langid.fit(docs, PIECES)
    index = {p: i for i, p in enumerate(model.pieces)}

    def brute(s):
        if not s:
            return np.ones(len(model.languages))
        total = np.zeros(len(model.languages))
        for n in range(1, min(len(s), langid.LONGEST) + 1):
            if s[:n] in index:
                total += np.exp(model.logs[index[s[:n]]]) * brute(s[n:])
            elif n == 1:
                total += np.exp(model.unknown) * brute(s[1:])
        return total

    found = langid.forward(langid.Pieces(model.pieces).lattice(["▁chatñx", "▁the"]), model.logs, model.unknown)
    assert np.allclose(found, [np.log(brute("▁chatñx")), np.log(brute("▁the"))])
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert got == {i: "en" if i % 2 else "fr" for i in range(60)}
    rows = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (1, 2, 3, 11)) and all(0 <= r.score <= 1 for r in rows.values())
    long = ["▁the" + "chat" * 90, "▁" + "dogñ" * 2000]
    ways = langid.Pieces(model.pieces)
    mild = model.logs / 10  # small enough to need no scaling
    assert np.allclose(langid.forward_long(ways.lattice(long[:1]), mild, model.unknown / 10, ways.longest), langid.forward(ways.lattice(long[:1]), mild, model.unknown / 10))
    short = ["▁chatñx", "▁the", "▁dog"]
    assert np.allclose(langid.forward_long(ways.lattice(short), model.logs, model.unknown, ways.longest), langid.forward(ways.lattice(short), model.logs, model.unknown))
    assert np.isfinite(langid.forward_long(ways.lattice(long), model.logs, model.unknown, ways.longest)).all()
    empty = langid.fit(none, PIECES)
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"} and langid.predict(none, model).count() == 0


def test_chain_equals_enumeration():
    rng = np.random.default_rng(0)
    odds, moves = rng.normal(size=8), rng.normal(size=(2, 2))
    starts = np.array([0, 4, 7])
    p, pairs, away = toxicity.fields(odds, starts, moves)
    single, both, clean = [], np.zeros((2, 2)), []
    for o in (odds[:4], odds[4:7], odds[7:]):
        total, m, w = 0.0, np.zeros(len(o)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=len(o)):
            v = np.exp(sum(o[i] for i in range(len(o)) if y[i]) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            total += v
            m += v * np.array(y)
            for a, b in zip(y, y[1:]):
                w[a, b] += v
        single += (m / total).tolist()
        both += w / total
        clean.append(np.log(total) - moves[0, 0] * (len(o) - 1))
    assert np.allclose(p, single) and np.allclose(pairs.sum(axis=1).reshape(2, 2), both) and np.allclose(away, clean)
    assert np.allclose(p, toxicity.marginals(odds, starts, moves))


def test_likelihood_of_labels():
    """Its gradient against differences, in every kind of weight."""
    rng = np.random.default_rng(1)
    texts = [b"you silly Idiot. go home", b"a good day", b"", b"silly idiot! idiot", b"day by day. home"]
    e = toxicity.Examples(texts, np.array([1, 0, 0, 1, 0]))
    model = toxicity.Model(rng.normal(size=toxicity.SLOTS) * 0.3, rng.normal(size=(2, toxicity.SLOTS)) * 0.3, -0.7, rng.normal(size=(2, 2)), np.zeros(5))
    slots, sides, bias, moves = e.gradient(model)[1]

    def slope(array, at):
        before = array[at]
        values = []
        for d in (1e-5, -1e-5):
            array[at] = before + d
            values.append(e.gradient(model)[0])
        array[at] = before
        return (values[0] - values[1]) / 2e-5

    for s in (e.slot[0], e.slot[7], e.slot[-1]):
        assert slots[s] == pytest.approx(slope(model.slots, s), abs=1e-6)
    for side in (0, 1):
        for s in e.side[:6]:
            assert sides[side, s] == pytest.approx(slope(model.sides, (side, s)), abs=1e-6)
    for at in itertools.product((0, 1), repeat=2):
        assert moves[at] == pytest.approx(slope(model.moves, at), abs=1e-6)
    value = e.gradient(model)[0]
    up, down = (e.gradient(toxicity.Model(model.slots, model.sides, model.bias + d, model.moves, model.document))[0] for d in (1e-5, -1e-5))
    assert bias == pytest.approx((up - down) / 2e-5, abs=1e-6) and value < 0
    # what is read for scoring is what was fitted
    tokens, counts, starts, odds, _ = toxicity.Reader(model).read(texts)
    assert np.allclose(odds, e.odds(model)) and (starts == e.starts).all() and (counts == e.counts).all()


def test_spans_equal_plain_decoding(spark):
    """Spans are the runs of tokens whose marginal, by enumeration, is at least one half."""
    rng = np.random.default_rng(2)
    model = toxicity.Model(rng.normal(size=toxicity.SLOTS), rng.normal(size=(2, toxicity.SLOTS)), -0.2, rng.normal(size=(2, 2)), np.array([0.1, 1, 1, 0.5, 0.2]))
    texts = ["one two. three fours five", "  éa b\tc. d", "x", "", "one one one two"]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        found = [(m.start(), m.end(), m[0]) for m in re.finditer(rb"[^ \t\n]+", text.encode())]
        sentences, own = [], []
        for token in found:
            own.append(token)
            if token[2][-1:] in (b".", b"!", b"?"):
                sentences.append(own)
                own = []
        hits = []
        for tokens in [*sentences, own]:
            kinds = [toxicity.token_slots(t[2]) for t in tokens]
            odds = [model.bias + model.slots[k[0]].sum() + (model.sides[0, kinds[n - 1][1]] if n else 0) + (model.sides[1, kinds[n + 1][1]] if n + 1 < len(kinds) else 0) for n, k in enumerate(kinds)]
            ways = list(itertools.product((0, 1), repeat=len(odds)))
            w = np.exp([sum(o for o, y in zip(odds, way) if y) + sum(model.moves[a, b] for a, b in zip(way, way[1:])) for way in ways])
            p = w @ np.array(ways).reshape(len(ways), -1) / w.sum()
            hits += [(t, q >= 0.5) for t, q in zip(tokens, p)]
        spans, last = [], None
        for n, ((a, b, _), hit) in enumerate(hits):
            if hit and last == n - 1:
                spans[-1] = (spans[-1][0], b)
            elif hit:
                spans.append((a, b))
            last = n if hit else last
        assert [(s.start, s.end) for s in got[i].spans] == spans


def test_held_out_documents(spark):
    """The field against a rule that calls a document toxic for one word of great log-odds, both learned from the same documents."""
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = documents.join(labels.where("toxic is not null").select("doc_id", "toxic"), "doc_id").where("text is not null").select("doc_id", "text", "toxic").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    seen: dict[int, dict[str, int]] = {0: {}, 1: {}}
    total = [0, 0]
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 5:
            total[r.toxic] += 1
            for w in {toxicity.word_of(t) for t in r.text.encode().split()}:
                seen[r.toxic][w] = seen[r.toxic].get(w, 0) + 1
    share = lambda w, k: (seen[k].get(w, 0) + 0.5) / (total[k] + 1)
    bad = {w for w, n in seen[1].items() if n >= 4 and np.log(share(w, 1) / (1 - share(w, 1)) * (1 - share(w, 0)) / share(w, 0)) >= 2.5}
    rule = {r.doc_id: any(toxicity.word_of(t) in bad for t in r.text.encode().split()) for r in held}
    got = {r.doc_id: r.predicted == 1 for r in queries.op7_toxicity(spark, sf).where("held_out").collect()}
    rates = {}
    for name, told in (("word rule", rule), ("field", got)):
        hit = sum(told[r.doc_id] and r.toxic == 1 for r in held)
        rates[name] = (np.mean([told[r.doc_id] == (r.toxic == 1) for r in held]), hit / sum(r.toxic for r in held), hit / max(1, sum(told[r.doc_id] for r in held)))
        print(f"{name}: accuracy {rates[name][0]:.4f}, recall {rates[name][1]:.4f}, precision {rates[name][2]:.4f} on {len(held)} documents")
    assert rates["field"][0] >= max(0.985, rates["word rule"][0] - 1e-9) and rates["field"][1] >= 0.9


def test_toxicity(spark, odd, none):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        own = [rng.choice(VOCABULARY) for _ in range(30)]
        if i % 4 == 0:
            own[rng.randrange(30)] = rng.choice(["scum", "Idiot,", "trash."])
        rows.append((i, " ".join(own)))
        labels.append((i, int(i % 4 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs.where("doc_id % 5 <> 0"), marks)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(0, 400, 5)]
    assert np.mean([got[i].predicted == int(i % 4 == 0) for i in held]) >= 0.95
    i = next(i for i in held if i % 4 == 0)
    s = got[i].spans[0]
    assert re.sub(r"\W", "", rows[i][1].encode()[s.start : s.end].decode().lower()) in ("scum", "idiot", "trash")
    found = toxicity.score(odd, model).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found) and toxicity.score(none, model).count() == 0
    assert {r.predicted for r in toxicity.score(odd, toxicity.fit(none, marks)).collect()} == {0}


def test_conflicting_labels(spark):
    """A document with both labels counts as toxic, whichever row comes first."""
    rows = [(i, " ".join(f"w{i * 7 + j}" for j in range(20)) + (" scum" if i % 2 else "")) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, i % 2) for i in range(40)] + [(i, 0) for i in range(40)]
    models = [toxicity.fit(docs, spark.createDataFrame(m, "doc_id long, toxic int").repartition(3)) for m in (marks, marks[::-1], marks[:40])]
    assert all((m.document == models[0].document).all() and (m.slots == models[0].slots).all() for m in models)


def plain_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard(spark, odd, none, monkeypatch):
    for name, value in (("GROUP", 10), ("TILE_PAIRS", 20), ("TILE_BYTES", 4096)):  # several blocks and parts
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(3)
    base = [rng.choice(VOCABULARY) for _ in range(60)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(60)] = rng.choice(VOCABULARY)
        rows.append((i, " ".join(own if i % 3 else own[: rng.randint(0, 12)])))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.components(odd).collect()} == plain_components(ODD)
    assert jaccard.components(odd).count() == len(ODD) and jaccard.components(none).count() == 0


def test_bitmaps_bound_the_overlap():
    """No pair that links is left out by its bitmaps, and pairs that share little are."""
    rng = np.random.default_rng(5)
    for n in (1, 5, 140, 3000):
        for share in (0.0, 0.3, 0.75, 0.9, 1.0):
            both = int(n * share)
            x, y = (np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))[:n] for _ in range(2))
            y = np.unique(np.concatenate([x[:both], y[both:]]))
            found = len(np.intersect1d(x, y))
            maps = np.stack([jaccard.bitmap(s, jaccard.MAP_BITS) for s in (x, y)])
            assert jaccard.most_shared(maps[0], len(x), maps[1], len(y)) >= found
            args = np.array([1, 2]), np.array([len(x), len(y)]), np.array([0, 0]), 3, 4
            pairs = list(zip(*jaccard._pairs_of_group(*args, maps=maps)))
            if 4 * found >= 3 * (len(x) + len(y) - found):
                assert len(pairs) == 1
            elif n == 140 and share <= 0.3:
                assert not pairs and len(jaccard._pairs_of_group(*args)[0]) == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def plain_reach(edges):
    out = {x: x for e in edges for x in e if e[0] != e[1]}
    while True:
        before = dict(out)
        for a, b in edges:
            if a != b:
                out[a] = out[b] = min(out[a], out[b])
        if out == before:
            return out


@pytest.mark.parametrize("n, parts", [(60, 1), (60, 7), (300, 20)])
def test_components_of_parts(spark, n, parts):
    """Edges in many parts, repeated ones, both ways round, long paths and a star."""
    rng = random.Random(n + parts)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)] + [(1000 + (i * 7) % n, 1000 + (i * 7 + 7) % n) for i in range(n - 5)]
    edges += [(b, a) for a, b in edges[::3]] + [(5000, 5000 + i) for i in range(n)] + edges[:9]
    table = spark.createDataFrame([*edges, (None, 3), (4, None)], "a long, b long").repartition(parts)
    rows = connected_components(table).collect()
    assert {r.node: r.component for r in rows} == plain_reach(edges)
    assert len(rows) == len({r.node for r in rows})


def test_components_of_many_batches(spark, monkeypatch):
    """Shares that gain little start again, others go on; no edge is lost between them."""
    monkeypatch.setattr(components, "AT_ONCE", 25)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        edges = [(i, i + 1) for i in range(90)] + [(200 + i % 5, 203) for i in range(60)] + [(90 - i, 300 + i) for i in range(40)]
        rows = connected_components(spark.createDataFrame(edges, "a long, b long").coalesce(1)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r.node: r.component for r in rows} == plain_reach(edges)


def test_forest():
    rng = np.random.default_rng(3)
    u, v = rng.integers(-500, 500, 400), rng.integers(-500, 500, 400)
    node, root = forest(u, v)
    reach = plain_reach(list(zip(u.tolist(), v.tolist())))
    assert dict(zip(node.tolist(), root.tolist())) == {x: c for x, c in reach.items() if x != c}
    assert not len(forest(u[:0], v[:0])[0])


def plain_repeats(docs, length):
    seen, out = {}, {}
    for i, t in sorted(docs.items()):
        gone = np.zeros(len(t), dtype=bool)
        for s in range(len(t) - length + 1):
            if t[s : s + length] in seen:
                gone[s : s + length] = True
            else:
                seen[t[s : s + length]] = 1
        out[i] = gone
    return out


def test_suffix_shards():
    rng = random.Random(9)
    for trial in range(12):
        docs = {i: bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 60))) for i in range(20)}
        spans = list(docs.values())
        d, s = suffix.repeated_starts(spans, np.array(list(docs)), np.zeros(20, dtype=np.int64), 16, (50, 200, 10**6)[trial % 3])
        got = {i: np.zeros(len(t), dtype=bool) for i, t in docs.items()}
        for a, b in zip(d.tolist(), s.tolist()):
            got[a][b : b + 16] = True
        want = plain_repeats(docs, 16)
        assert all((got[i] == want[i]).all() for i in docs)


def test_suffix_prefixes():
    raw = np.frombuffer(b"abracadabra abracadabra abracad", dtype=np.uint8)
    shard = suffix.Shard(raw, len(raw) - np.arange(len(raw)), 10)
    text = raw.tobytes()
    assert [text[i : i + 10] for i in shard.order] == sorted(text[i : i + 10] for i in range(len(text) - 9))
    for k in range(1, len(shard.order)):
        a, b = text[shard.order[k - 1] :], text[shard.order[k] :]
        assert shard.prefix[k] == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    # neighbours that have nothing in common, followed by neighbours that do
    docs = np.array([1, 2]), np.zeros(2, dtype=np.int64)
    assert len(suffix.repeated_starts([b"x\xa9" + text * 4, b"\xb1" + text * 4 + b"!"], *docs, 100)[0]) == 4 * len(text) - 99


def test_suffix_operator(spark, odd, none):
    rows = suffix.remove_repeats(odd).collect()
    docs = {i: (t or "").encode() for i, t in ODD}
    want = plain_repeats(docs, 100)
    assert len(rows) == len(ODD)
    for r in rows:
        gone = want[r.doc_id]
        assert bytes(r.kept) == bytes(np.frombuffer(docs[r.doc_id], dtype=np.uint8)[~gone]) and r.n_bytes == len(gone)
        assert len(r.spans) == int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
    assert suffix.remove_repeats(none).count() == 0
    text = "é" + words(60)
    rows = [(2**60 + 1, "x" + text), (2**60 + 3, "ñ" + text[1:] + "é"), (None, text)]
    got = {r.doc_id: r for r in suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), whole_characters=True).collect()}
    assert bytes(got[None].kept).decode() == text and bytes(got[2**60 + 1].kept).decode() == "x" + text and bytes(got[2**60 + 3].kept).decode() == "ñé"
    shared = words(60)
    pair = spark.createDataFrame([(1, "a" + shared + "é"), (2, "b" + shared + "è\ufffd")], "doc_id long, text string")  # the run's last byte begins another character
    kept = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(pair, whole_characters=True).collect()}
    assert kept[1].decode() == "a" + shared + "é" and kept[2].decode() == "b\ufffd"


def test_license(spark, odd, none):
    rows = [(1, "Released under the MIT License."), (2, "x cc-by cc by CC BY."), (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files"), (4, "mit licenses"), (5, None), (6, "MIT\nLicense mit license")]
    got = {r.doc_id: r for r in license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].labels) == (5, 1, 3, "mit,mit-release")
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].base_labels) == (3, 1, 5, "cc-by")
    assert (got[3].n_base, got[3].base_labels, got[3].labels, got[3].first_word) == (0, "", "mit-grant", None) and 0.8 <= got[3].score < 1
    assert (got[4].n_base, got[4].score) == (0, 0.0) and (got[5].n_words, got[5].labels) == (0, "") and got[6].n_base == 2
    assert license.scan(odd).count() == len(ODD) and license.scan(none).count() == 0
    assert {r.n_words for r in license.scan(odd).where("doc_id in (1, 2, 3)").collect()} == {0}


def test_license_is_native(spark, odd):
    plan = license.scan(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_anchors_of_long_texts(monkeypatch):
    """A text with more places than fit beside the hash has the anchors that it has with room for all of them."""
    rng = random.Random(6)
    text = bytes(rng.randrange(256) for _ in range(3000)) * 3
    whole = suffix.anchors([text, text[:500]])
    monkeypatch.setattr(suffix, "PLACE_BITS", suffix.np.uint64(11))
    assert all((a == b).all() for a, b in zip(whole, suffix.anchors([text, text[:500]])))
    h = suffix.np.random.default_rng(2).integers(0, 2**63, 5000).astype("uint64")
    least = [i + int((h[i : i + 69] >> suffix.PLACE_BITS).argmin()) for i in range(len(h) - 68)]
    assert suffix._least(h, 69).tolist() == least


def test_language_bounds(spark):
    """Every language is learned, however many there are, and every letter piece of the vocabulary is known."""
    import sentencepiece

    letters = "abcdefghijklmnopqrstuvwxyz"
    docs = spark.createDataFrame([(i, f"l{i:03d}", " ".join([letters[i % 26] * 3 + letters[i // 26] * 3] * 3)) for i in range(230)], "doc_id long, lang string, text string")
    model = langid.fit(docs, PIECES)
    assert model.languages == [f"l{i:03d}" for i in range(230)]
    assert sum(r.lang == r.lang_pred for r in langid.predict(docs, model).join(docs, "doc_id").collect()) >= 225
    known = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert {p for p in (known.id_to_piece(i).lower() for i in range(known.get_piece_size())) if p.lstrip("▁") and all(unicodedata.category(c)[0] == "L" for c in p.lstrip("▁"))} <= set(model.pieces)


def test_rows_with_one_id_and_different_texts(spark):
    """Neither the ranges nor the labels of one text go to another one of the same id."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    p, a, b = text(150), text(300), text(600)
    rows = [(1, p), (2, a + p), (2, b), (3, b), (3, b), (2, "x" + a[:120])]
    got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    kept = sorted((r.doc_id, bytes(r.kept).decode()) for r in got)
    first = [(2, a), (2, "x")] if (2, a) in kept else [(2, a[120:]), (2, "x" + a[:120])]  # whichever hash is smaller
    assert kept == sorted([(1, p), *first, (2, b), (3, ""), (3, "")])
    notice = "licensed under the apache license version 2 0"
    rows = [(1, notice), (1, "plain words only here"), (None, notice), (None, "nothing"), (2, None)]
    got = license.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.labels) for r in got) == [("1", 4, ""), ("1", 8, "apache,apache-2.0"), ("2", 0, ""), ("None", 1, ""), ("None", 8, "apache,apache-2.0")]
