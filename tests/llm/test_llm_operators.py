"""Each operator against plain Python, and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from punctua.llm import charlm, hnsw, licences, linechunks, minhash, packing, pieces, topk, toxicity, urls, warc
from punctua.llm.common import Workspace
from punctua.llm.queries import tokenizer

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, set int, id int"
AWKWARD = [None, "", " \n\t", "word", "the same words once more here", "the same words once more here", "ÀÉ漢字 😀\0x",
           "a " * 5000, "x" * 20000, "one two three four five\nsix seven"]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, None, None, None, 1, 2, 3) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, None, None, None, 1, 2, 3) for i, t in enumerate(AWKWARD)] + [(None, "no id", None, None, None, 1, 2, 3)] * 2
    return spark.createDataFrame(rows + rows[3:4], DOCS)


@pytest.fixture
def work(spark):
    return Workspace(spark, "test")


def test_near_duplicates_match_brute_force(spark, work):
    rng = np.random.default_rng(3)
    texts = []
    for g in range(12):
        base = [f"w{rng.integers(300)}" for _ in range(60)]
        for _ in range(8):
            own = list(base)
            for k in rng.integers(0, 60, rng.integers(0, 9)):
                own[k] = f"x{rng.integers(9999)}"
            texts.append(" ".join(own))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs_of(spark, texts), work, width=2, block=4).collect()}
    sets = [set(zip(t.split(), t.split()[1:])) for t in texts]
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        for a in range(len(texts)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if all(root[r] == r for r in root):
            break
    assert [got[i]["component_id"] for i in range(len(texts))] == root
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]


def test_near_duplicates_awkward(spark, awkward, work):
    got = minhash.near_duplicates(awkward, work, width=2).collect()
    assert len(got) == awkward.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[0]["n_shingles"] == by[2]["n_shingles"] == 0 and by[0]["kept"]
    assert by[5]["component_id"] == 4 and by[3]["n_shingles"] == 1
    assert all(r["component_id"] is None and not r["kept"] for r in got if r["doc_id"] is None)
    assert minhash.near_duplicates(awkward.limit(0), work).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    rows, base = [], rng.normal(size=(20, 8))
    for i in range(300):
        rows.append((i, [float(np.float32(x)) for x in base[i % 20] + rng.normal(size=8) * 0.15], 0))
    rows += [(300, None, 0), (301, [0.0] * 8, 0), (302, [1.0, None] + [0.0] * 6, 0), (303, [float("nan")] * 8, 0),
             (304, [1.0, 2.0], 0), (350, rows[0][1], 0), (None, rows[0][1], 0)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def test_embedding_groups_match_brute_force(vectors, work):
    got = {r["vec_id"]: r for r in hnsw.embedding_groups(vectors, work, shards=3).collect()}
    rows = [r for r in vectors.collect() if r["vec_id"] is not None and (r["vec_id"] < 300 or r["vec_id"] == 350)]
    v = np.array([r["embedding"] for r in rows])
    v /= np.sqrt((v**2).sum(1))[:, None]
    links = v @ v.T >= 0.95
    np.fill_diagonal(links, False)
    assert [got[r["vec_id"]]["n_links"] for r in rows] == links.sum(1).tolist()
    root = np.arange(len(rows))
    for _ in rows:
        root = np.minimum(root, np.where(links, root[None, :], len(rows)).min(1))
    assert [got[r["vec_id"]]["component_id"] for r in rows] == [rows[k]["vec_id"] for k in root]
    assert got[301]["n_links"] == 0 and got[301]["kept"] and not got[None]["kept"]


def test_embedding_groups_of_repeated_ids_and_empty_tables(spark, vectors, work):
    rows = [(1, [1.0, 0.0], "x"), (1, [1.0, 0.001], "y"), (2, [1.0, 0.01], "z"), (3, [0.0, 1.0], "x"), (3, [1.0, 0.02], "y")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n_links string")
    got = sorted(tuple(r) for r in hnsw.embedding_groups(df, work, shards=2).collect())
    assert got == [(1, 2, 1, True)] * 2 + [(2, 2, 1, False)] + [(3, 2, 1, False)] * 2
    assert hnsw.embedding_groups(vectors.limit(0), work).count() == 0


def test_the_audit_widens_beams_without_real_links():
    """Self links and a lack of near copies hide nothing: planted links decide, whatever the beam begins with."""
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(3000, 24))
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    ids, world = np.arange(3000), hnsw.SmallWorld(unit)
    at, near = hnsw.planted(unit, 0.95)
    assert np.allclose(np.einsum("ij,ij->i", near, unit[at]), 0.951) and len(at) == 256
    beams, search = [], world.search
    world.search = lambda q, beam: beams.append(beam) or search(q, beam)
    counts, _, _ = hnsw.links_in_shard(world, ids, unit, ids, unit, 0.95, 0.995, 1, 50)
    assert counts.sum() == 0 and max(beams) > 1
    found = (search(near, max(beams))[0] == at[:, None]).any(1).mean()
    assert found >= 0.995


def test_top_k_matches_brute_force(vectors, work):
    got = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, block=64, bits=3).collect()
    rows = {r["vec_id"]: np.floor(np.array(r["embedding"], float) * 256) for r in vectors.collect()
            if r["vec_id"] is not None and r["embedding"] and len(r["embedding"]) == 8 and None not in r["embedding"] and r["vec_id"] != 303}
    for q in (0, 50, 350):
        want = sorted(((-int(v @ rows[q]), i) for i, v in rows.items() if i != q))[:5]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want
    assert topk.top_k(vectors.limit(0), vectors.limit(0), 5).count() == 0


def test_pieces_equal_the_library(spark, awkward):
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(5)
    texts = AWKWARD + ["  lead", "▁y a▁▁b", " " * 90 + "b"] + ["".join(rng.choice(list("ab éß 1\n"), 40)) for _ in range(200)]
    rows = pieces.encoded(docs_of(spark, texts), path)
    for r in rows.collect():
        assert list(r["ids"]) == sp.encode(texts[r["doc_id"]] or "", add_bos=True, add_eos=True)
    for r in pieces.decoded(rows, path).collect():
        assert r["text"] == (texts[r["doc_id"]] or "").replace("▁", " ")
    model = pieces.PieceModel(path)
    for ids in ([1, 202, 2, 139, 28705, 0, 5422], [3 + 0xE9], [3 + 0xE9, 300, 3 + 0x80], [1, 259, 300], [0]):
        assert model.decode(np.array(ids), np.array([0, len(ids)]))[0].decode() == sp.decode(ids)


def test_packing_keeps_every_id_once(spark, awkward, work):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack(awkward.where("doc_id is not null").dropDuplicates(["doc_id"]), work, path, window=64, shard_docs=3).collect()
    for i, t in enumerate(AWKWARD):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for s in {r["sequence_id"] for r in rows}:
        own, at = sorted((r["offset"], r["length"]) for r in rows if r["sequence_id"] == s), 0
        for offset, n in own:
            assert offset == at
            at += n
        assert at <= 64 and at & (at - 1) == 0
    assert packing.pack(awkward, Workspace(spark, "t"), path).where("doc_id is null").count() == 2
    assert packing.pack(awkward.limit(0), Workspace(spark, "t"), path).count() == 0


def test_warc_round_trip_and_seek(spark, work):
    html = ["<p>é</p>", "", None, "<p>é</p>", "z" * 5000, "<p>é</p>"]
    pages = spark.createDataFrame([(i, "http://a/\r\n" if i else None, h, 9) for i, h in enumerate(html)] + [(None, "u", "<p>é</p>", 9)],
                                  "page_id bigint, url string, html string, digest int")
    index = warc.write_bundles(pages, work, frame_bytes=512)
    rows = {r["page_id"]: r for r in warc.read_bundles(index).collect()}
    assert len(rows) == 7 and rows[5]["record_type"] == "response" and rows[0]["refers_to"] == rows[3]["refers_to"] == 5
    assert rows[1]["refers_to"] == 2 and rows[None]["record_type"] == "response"
    assert bytes(rows[4]["payload"]).decode() == html[4] and rows[0]["payload_bytes"] == len(html[0].encode())
    at = index.where("page_id = 4").first()
    head, block = warc.read_record(at["bundle"], at["frame"], at["at"])
    assert head["WARC-Record-ID"] == at["record_id"] and block.endswith(b"z" * 5000)
    assert warc.read_bundles(warc.write_bundles(pages.limit(0), work)).count() == 0


def test_line_chunks(spark, awkward, work):
    passage = "\n".join(" ".join(f"p{k}x{j}" for j in range(12)) for k in range(12))
    texts = [f"own {i}\n{passage}\ntail {i}" for i in range(3)] + ["common line\nother", "common line\nother"]
    got = {r["doc_id"]: r for r in linechunks.dedup_lines(docs_of(spark, texts), work).collect()}
    assert got[0]["text"] == texts[0] and got[3]["text"] == got[4]["text"] == texts[3]
    assert all(got[i]["removed"] > 0 and got[i]["text"].startswith(f"own {i}") and len(got[i]["text"]) < len(texts[i]) for i in (1, 2))
    long_line = " ".join(f"l{k}" for k in range(60))
    got = {r["doc_id"]: r["text"] for r in linechunks.dedup_lines(docs_of(spark, ["a\n" + long_line, "b\n" + long_line + "\nc"]), work).collect()}
    assert got == {0: "a\n" + long_line, 1: "b\nc"}
    out = linechunks.dedup_lines(awkward, work)
    assert out.count() == awkward.count() and out.where("doc_id = 0").first()["text"] is None
    assert linechunks.dedup_lines(awkward.limit(0), work).count() == 0


def test_packing_finds_neighbours_in_other_shards(spark, work):
    """Most pieces lie beside one of their own topic, though a shard holds a sixteenth of the tails."""
    rng = np.random.default_rng(4)
    topics = [[f"{a}{b}{c}" for a, b, c in zip(*(rng.choice(list(x), 60) for x in ("bdfgklmnprst", "aeiou", "bdfgklmnprst")))] for _ in range(64)]
    texts = [" ".join(topics[i % 64][k] for k in rng.integers(0, 60, 60)) for i in range(2048)]
    rows = packing.pack(docs_of(spark, texts), work, tokenizer("word_bpe_49k.json"), window=512, shard_docs=128).collect()
    windows = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append(r["doc_id"] % 64)
    same = [np.mean([t == o for o in w[:i] + w[i + 1:]]) for w in windows.values() if len(w) > 1 for i, t in enumerate(w)]
    assert np.mean(same) > 0.5 and {r["doc_id"] for r in rows} == set(range(2048))
    # Copies of one text fill no shard of their own.
    x = np.repeat(np.random.default_rng(1).normal(size=(1, 8)).astype(np.float32), 4096, 0)
    assert np.bincount(packing.WordingTree(x, np.arange(4096), 3).leaf(x, np.arange(4096)), minlength=8).max() < 700


def test_passages_of_short_lines(spark, awkward, work):
    def own(tag):
        return "\n".join(" ".join(f"{tag}{k}y{j}" for j in range(20)) for k in range(3))

    texts, want = [], []
    for lines, words in ((2, 40), (3, 20), (4, 15), (5, 12), (8, 10), (10, 10)):
        for n in range(4):
            tag = f"{lines}z{words}z{n}"
            passage = "\n".join(" ".join(f"{tag}p{k}x{j}" for j in range(words)) for k in range(lines))
            for copy in "ab":
                texts.append(f"{own(tag + copy)}\n{passage}\n{own(tag + copy + 'e')}")
                want.append(texts[-1] if copy == "a" else f"{own(tag + copy)}\n{own(tag + copy + 'e')}")
    texts += ["common line\nother\nq", "common line\nother\nr"]
    want += texts[-2:]
    got = {r["doc_id"]: r for r in linechunks.dedup_passages(docs_of(spark, texts), work).collect()}
    assert [got[i]["text"] for i in range(len(texts))] == want
    assert [got[i]["removed"] for i in (0, 1, 3)] == [0, 2, 2] and got[1]["n_lines"] == 8
    stage = corpus_pipeline.drop_repeated_lines(spark, docs_of(spark, texts), "")
    assert {r["doc_id"]: r["text"] for r in stage.collect()} == dict(enumerate(want))
    out = linechunks.dedup_passages(awkward, work)
    assert out.count() == awkward.count() and out.where("doc_id = 0").first()["text"] is None
    assert out.where("removed > 0").count() == 0 and linechunks.dedup_passages(awkward.limit(0), work).count() == 0


def test_passages_come_from_content_defined_chunks(spark, monkeypatch):
    """The pipeline looks up the chunks of the rolling hash, and pairs only where no repeated chunk answers."""
    kept = {}

    class Kept(Workspace):
        def store(self, df, name):
            kept[name] = super().store(df, name)
            return kept[name]

        def drop(self, *frames):
            pass

    monkeypatch.setattr(corpus_pipeline, "Workspace", Kept)
    block = [f"line {k} of the block" for k in range(60)]
    docs = docs_of(spark, ["\n".join([f"own {i}", *block, f"end {i}"]) for i in range(3)])
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()}
    assert out[0].count("\n") == 61 and out[1] == "own 1\nend 1" and out[2] == "own 2\nend 2"
    asked = [(r["id"], bytes(r["h"])) for r in kept["keyed"].collect()]
    parts = docs.select("doc_id", F.explode(linechunks.chunks(F.col("text"))).alias("c")).select("doc_id", "c.*").collect()
    many = [(r["doc_id"], hashlib.md5(r["text"].encode()).digest()) for r in parts if r["lines"] > 2]
    assert len(many) > 9 and set(many) <= set(asked)
    assert sum(i == 2 for i, _ in asked) < sum(i == 0 for i, _ in asked) - 20


def test_passages_equal_the_rule_on_pairs_of_lines(spark, work):
    """Whatever the chunks: a run of lines whose adjacent pairs stand earlier goes if it has the words."""
    rng = np.random.default_rng(12)
    pool = [" ".join(f"w{k}x{j}" for j in range([1, 4, 9, 55][k % 4])) for k in range(24)] + ["", "a b c"]
    texts = []
    for _ in range(60):
        lines = [pool[k] for k in rng.integers(0, len(pool), rng.integers(0, 12))]
        if texts and rng.random() < 0.7:
            old = texts[rng.integers(len(texts))].split("\n")
            a = rng.integers(len(old))
            lines[len(lines) // 2:len(lines) // 2] = old[a:a + rng.integers(1, 14)]
        texts.append("\n".join(lines))
    seen, want = set(), []
    for text in texts:
        lines, pairs, long = text.split("\n"), [], []
        for i, x in enumerate(lines):
            for found, unit in ((pairs, tuple(lines[i:i + 2])), (long, (x,))):
                found.append(unit in seen and (len(unit) == 2 or len(x.split()) >= 50))
                seen.add(unit) if len(unit) == 2 or found is long else None
        left, i = [], 0
        while i < len(lines):
            j = i
            while j < len(lines) - 1 and pairs[j]:
                j += 1
            run = lines[i:j + 1]
            goes = sum(len(x.split()) for x in run) >= 20 if j > i else long[i]
            left += [] if goes else run
            i = j + 1
        want.append("\n".join(left))
    assert sum(a != b for a, b in zip(texts, want)) > 10
    for one_in in (1, 4, 1000):
        got = {r["doc_id"]: r["text"] for r in linechunks.dedup_passages(docs_of(spark, texts), work, one_in=one_in).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_line_dedup_carries_clashing_names(spark, work):
    block = "\n".join(" ".join(f"w{k}x{j}" for j in range(15)) for k in range(5))
    rows = [(i, f"{block}\nown {i}", 1, 2, 3, 4, 5, 6.0) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, gone int, _id int, removed int, n_lines int, x int, toxic_score double")
    for got in (corpus_pipeline.drop_repeated_lines(spark, docs, ""), linechunks.dedup_lines(docs, work, out=("n_", "r_"))):
        got = {r["doc_id"]: r for r in got.collect()}
        assert [got[0][c] for c in docs.columns[2:]] == [1, 2, 3, 4, 5, 6.0] and got[3]["text"].endswith("own 3") and len(got[3]["text"]) < 200
    out = linechunks.dedup_passages(docs, work)
    assert out.columns.count("removed") == 1 and out.where("removed = 5").count() == 3


def test_the_line_stage_is_linear_in_lines(spark, work):
    """A filter over the result must not bring back a step once per line."""
    def seconds(n):
        docs = docs_of(spark, ["\n".join(f"{i} line" for i in range(n))] * 40)
        out = linechunks.dedup_passages(docs, work).where("removed > 0 and trim(text) = ''")
        began = time.perf_counter()
        assert out.count() == 39
        return time.perf_counter() - began
    seconds(50)
    few, many = min(seconds(100) for _ in range(2)), min(seconds(400) for _ in range(2))
    assert many < 4 * few + 0.5

    docs = docs_of(spark, ["\n".join(f"{i} line of some words" for i in range(20_000))] * 3)
    got = corpus_pipeline.drop_repeated_lines(spark, docs, "").collect()
    assert [r["doc_id"] for r in got] == [0]


def test_a_list_of_one_large_component_copies_only_the_rest(spark, work):
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(80)]
    texts = []
    for _ in range(60):
        own = list(base)
        own[rng.integers(80)] = f"x{rng.integers(10**6)}"
        texts.append(" ".join(own))
    for _ in range(8):  # about 0.6 alike
        own = list(base)
        for k in rng.permutation(80)[:12]:
            own[k] = f"y{rng.integers(10**6)}"
        texts.append(" ".join(own))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(spark, texts), work, width=2, block=5).collect()}
    sets = [set(zip(t.split(), t.split()[1:])) for t in texts]
    for i in range(60, 68):
        alike = [j for j in range(68) if j != i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        assert (got[i] == i) == (not alike or min(alike) > i)
    assert {got[i] for i in range(60)} == {0}


def test_licences_match_brute_force(spark, awkward):
    fill = " ".join(f"f{k}" for k in range(70))
    texts = [f"{fill} {t} {fill}" for t in licences.TEMPLATES.values()] + [fill, "MIT License"]
    got = {}
    for r in licences.licences(docs_of(spark, texts)).collect():
        got.setdefault(r["doc_id"], set()).add(r["licence"])

    def marks(t):
        w = re.findall("[a-z0-9]+", t.lower())
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    for i, t in enumerate(texts):
        want = {n for n, x in licences.TEMPLATES.items() if len(marks(x) & marks(t)) >= 0.8 * len(marks(x))}
        assert got.get(i, set()) == want
    assert licences.licences(awkward).count() == 0


def test_usual_licences_are_told_apart(spark):
    held = licences.usual_templates()
    lines = frozenset(n for n in held if "-line" in n)
    families = {n: "gnu" for n in held if n.startswith(("gpl-2", "gpl-3", "lgpl", "agpl")) and n not in lines}
    fill = " ".join(f"f{i}" for i in range(300))
    names = sorted(held)
    texts = [f"{fill} {held[n]} {fill}" for n in names]
    texts += ["Licensed under the MIT License", "licensed under Creative Commons BY-NC 4.0", "the MIT License",
              f"{held['lgpl-3.0']} {fill} {held['gpl-3.0']}", "x " * 1_500_000 + held["isc"]]
    got = {}
    for r in licences.licences(docs_of(spark, texts), held, families=families, whole=lines).collect():
        got.setdefault(r["doc_id"], set()).add(r["licence"])
    for i, n in enumerate(names):
        assert n in got[i]
        assert not {m for m in got[i] if families.get(m)} - {n} or n not in families, n
        words = re.findall("[a-z0-9]+", held[n].lower())
        for m in got[i] & lines:
            want = re.findall("[a-z0-9]+", held[m].lower())
            assert any(words[k:k + len(want)] == want for k in range(len(words))), (n, m)
    n = len(names)
    assert got[n] == {"mit-line-0-licensed"} and got[n + 1] == {"cc-by-nc-4.0-line-1-licensed"} and n + 2 not in got
    assert got[n + 3] == {"lgpl-3.0", "gpl-3.0"} and got[n + 4] == {"isc"}
    nameless = spark.createDataFrame([(None, held["isc"])], "doc_id bigint, text string")
    assert [r["doc_id"] for r in licences.licences(nameless, held).collect()] == [None]
    assert licences.licences(nameless.limit(0), held, families=families, whole=lines).count() == 0


def test_words_tokenise_as_whole_texts():
    """Ids of texts put together from their words are the tokenizer's own, with odd punctuation and letters too."""
    path = tokenizer("word_bpe_49k.json")
    words, rng = packing.WordIds(path), random.Random(5)
    parts = ["a", "B", "É", "e\u0301", "İ", "Σ", "ß", "3", "½", ".", ",", "..", "'s", "'", "!", "-", " ", "  ", "\n", "\x0b", "\u00a0", "\u0301", "日本", "x,", "K"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    for lot in (texts[:1500], texts[1500:]):  # the second lot meets remembered words
        flat, at = words.encode(pa.array([*lot, None]), 1)
        got = [flat[s:e].tolist() for s, e in zip(at[:-1], at[1:])]
        want = [[*words.tok.encode(x, add_special_tokens=False).ids, 1] for x in [*lot, ""]]
        assert got == want


def test_deobfuscation_and_toxicity(spark, awkward, work):
    rng = np.random.default_rng(2)
    names = ["river", "stone", "window", "garden", "table", "morning", "letter", "yellow", "bridge", "winter"]
    texts, labels = [], []
    for i in range(400):
        w = [names[k] for k in rng.integers(0, 10, 30)]
        bad = i % 4 == 0
        if bad:
            w[5] = w[9] = "moron"
        texts.append(" ".join(w))
        labels.append((i, 1, int(bad)))
    docs = docs_of(spark, texts)
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), work)
    tests = ["river stone window", "river moron stone moron", "river m0r0n stone m0r0n", "you m o r o n and moooron table", None, ""]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs_of(spark, tests), model).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 0, 5: 0}
    restorer = charlm.Restorer(model.language)
    assert restorer.word("m0r0n") == "moron" and restorer.word("river") == "river"
    assert toxicity.toxicity(awkward, model).count() == awkward.count()
    none = toxicity.fit_toxicity(docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), work)
    assert toxicity.toxicity(awkward, none).where("predicted = 1").count() == 0


def test_disguised_words_reach_the_decoder():
    words = ["idiot", "stupid", "ass", "moron", "book", "letter", "anna", "river", "window", "coffee", "table"]
    lines = [" ".join(words[i:] + words[:i]) for i in range(len(words))] * 40
    grams = np.zeros(charlm.SIZE**3, np.int64)
    for b in charlm._count(iter([pa.RecordBatch.from_arrays([pa.array(lines)], names=["text"])])):
        grams[b.column(0).to_numpy()] = b.column(1).to_numpy()
    restorer = charlm.Restorer(charlm.log_model(grams.reshape((charlm.SIZE,) * 3)))
    hidden = {"1d107": "idiot", "a55": "ass", "a$$": "ass", "4$$": "ass", "id1o7": "idiot", "5tup1d": "stupid", "stuupid": "stupid", "iddiot": "idiot", "m0r0n": "moron"}
    assert {w: toxicity._restored(w, restorer) for w in hidden} == hidden
    for w in ["book", "letter", "anna", "coffee", "river", "2024", "1,000", "$100", "100$", "3.14", "+44"]:
        assert toxicity._restored(w, restorer) == w


def test_the_decoder_equals_exhaustive_search(spark, work):
    """Every reading of short disguised words, scored in full, against Viterbi."""
    words = "stupid idiot trash good reading people letters stuff fool hello water coffee".split()
    model = charlm.log_model(charlm.count_grams(docs_of(spark, [" ".join(words[k:] + words[:k]) for k in range(12)])))
    restorer = charlm.Restorer(model)

    def readings(edges, i, text, cost):
        if i == len(edges):
            yield text, cost
            return
        for j, out, extra in edges[i]:
            yield from readings(edges, j, text + out, cost + extra)

    def scored(text, cost):
        codes = [charlm.SPACE] * 2 + [charlm.CODE.get(c, charlm.OTHER) for c in text] + [charlm.SPACE]
        return cost - sum(float(model[codes[k], codes[k + 1], codes[k + 2]]) for k in range(len(codes) - 2))

    rng = random.Random(6)
    swaps = {"o": "0", "i": "1!|", "e": "3", "a": "4@", "s": "5$", "t": "7+", "l": "1|", "g": "69"}
    tried = ["", "5|u7", "a$$", "stuupid", "coooool", "1!|1", "s t u p i d", "xq9", "ß3€"]
    for w in words:
        tried.append("".join(rng.choice(swaps[c]) if c in swaps and rng.random() < 0.6 else c for c in w))
    for s in tried:
        edges = restorer._edges(s, any(x in s for x in " .-_*"))
        every = {}
        for text, cost in readings(edges, 0, "", 0.0):
            every[text] = min(every.get(text, np.inf), scored(text, cost))
        got = restorer.decode(s)
        assert every[got] == pytest.approx(min(every.values()), abs=1e-4), (s, got)


def test_url_rules_equal_plain_python(spark, work):
    rng = random.Random(9)
    hosts = ["example.org", "www.EXAMPLE.org", "example.com", "notexample.org", "a.com", "com", "x.de", "ÀB.com", ""]
    paths = ["", "/", "/es/", "/en/1", "/en/12/x", "/fr/a", "/FR/a", "/de/", "/de", "/a://b/de/"]
    urls_ = [f"{rng.choice(['http', 'https', ''])}{rng.choice(['://', '://', ':/'])}{rng.choice(hosts)}{rng.choice(paths)}"
             f"{rng.choice(['', '?q=/es/', '#de/', '?a&b#c'])}" for _ in range(400)]
    urls_ += [None, "", "://", "a\nb://example.org/es/\nx", "http://example.org/es/" + "y" * 1_000_000]
    urls_ += urls_[:3]
    df = spark.createDataFrame([(k % 400, u, "clash") for k, u in enumerate(urls_)], "page_id long, url string, host string")
    labelled = spark.createDataFrame([], "url string, bad int")
    model = urls.fit_urls(labelled, work)

    def judged(k, u):
        host = path = ""
        if u is not None and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [r for r, _ in urls.RULES
                if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
        rule = max(fits, key=len, default=None)
        return k % 400, host, path, rule, dict(urls.RULES).get(rule, "allow")

    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df, model).collect()]
    assert sorted(got, key=repr) == sorted((judged(k, u) for k, u in enumerate(urls_)), key=repr)
    assert urls.judge_urls(df.limit(0), model).count() == 0


def test_url_rules_and_model(spark, work):
    rows = [f"https://{'www.casino-win' if i % 3 == 0 else 'blog.stone'}.example.net/en/{i}{'?a=1&b=2' if i % 3 == 0 else ''}" for i in range(300)]
    labelled = spark.createDataFrame([(u, int(i % 3 == 0)) for i, u in enumerate(rows)], "url string, bad int")
    model = urls.fit_urls(labelled, work)
    tests = [None, "no scheme", "http://A.ORG/x", "https://m.example.org/es/1?x", "http://example.org/en/15#t", "http://xexample.org/es/1",
             "http://b.com/de/1", "http://org?x", "ftp://x/a://b/c", "https://www.casino-win.example.net/en/9?a=1&b=2", "https://blog.stone.example.net/en/7"]
    pages = spark.createDataFrame([(i, u, 0.0) for i, u in enumerate(tests)], "page_id bigint, url string, length double")
    got = {r["page_id"]: r for r in urls.judge_urls(pages, model).collect()}
    assert [(got[i]["host"], got[i]["path"]) for i in (0, 1, 2, 7, 8)] == [("", ""), ("", ""), ("a.org", "/x"), ("org", ""), ("x", "/a://b/c")]
    assert [got[i]["rule"] for i in range(2, 8)] == ["org/", "example.org/es/", "example.org/en/1", "org/", "com/de/", None]
    assert [got[i]["verdict"] for i in (2, 3, 4, 5, 6, 9, 10)] == ["allow", "block", "block", "allow", "block", "block", "allow"]
    one = urls.fit_urls(labelled.limit(0), work)
    assert {r["verdict"] for r in urls.judge_urls(pages, one).where("rule is null").collect()} == {"allow"}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    good = [" ".join(f"w{(7 * i + 13 * k * (i + 1)) % 997}" for k in range(40)) for i in range(60)]
    texts = good + [good[0].replace("w0 ", "new "), good[1]] + [None, ""]
    docs_of(spark, texts).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        docs = out
    left = {r["doc_id"] for r in docs.collect()}
    assert set(range(60)) <= left and 61 not in left and 60 not in left and {62, 63} <= left
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == left
