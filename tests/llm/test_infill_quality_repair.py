"""Fill-in-the-middle, quality rules and conversation repair against plain Python and SQL twins."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from punctua.llm import infill, quality, queries, repair
from punctua.llm.common import Workspace

DOCS = "doc_id bigint, text string, n string, form string, id int, quality int, infill int"
AWKWARD = [None, "", " \n\t", "\n", "\n\n", "one", "one\n", "a\nb", "a\r\nb\n\nc", "has <M> inside\nx", "<P", "<S\n>S>", "ÀÉ漢字\n😀\0x\n",
           "w " * 60, "the same line here\n" * 40, "x" * 5000, "\n".join(f"line {i} <" for i in range(700)), "a b c " * 300]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    texts = AWKWARD + ["".join(rng.choice(["a", "b ", "\n", "é", "<P", ">", ". "]) for _ in range(rng.randrange(300))) for _ in range(60)]
    rows = [(i, t, "n", "f", 1, 2, 3) for i, t in enumerate(texts)] + [(None, "no id\nx", "n", "f", 1, 2, 3)] + [(7, "a\nb", "n", "f", 1, 2, 3)]
    return spark.createDataFrame(rows, DOCS)


def cut_by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_infill_equals_plain_python_and_comes_back(docs):
    got = infill.restored(infill.fill_in_middle(docs)).collect()
    given = docs.collect()
    assert len(got) == len(given)
    for r, d in zip(got, given):
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["infill"]) == cut_by_hand(d["doc_id"], d["text"])
        assert r["restored"] == (d["text"] or "") and r["doc_id"] == d["doc_id"]
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_infill_rates_empty_tables_and_long_texts(spark, docs):
    assert {r["form"] for r in infill.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in infill.fill_in_middle(docs, spm_rate=100).collect()} == {"plain", "spm"}
    assert infill.restored(infill.fill_in_middle(docs.limit(0))).count() == 0
    long = "".join(f"line {i}\n" for i in range(300_000))
    row = infill.restored(infill.fill_in_middle(spark.createDataFrame([(1, long)], "doc_id bigint, text string"))).first()
    assert row["restored"] == long and row["n"] == 300_000 and row["form"] != "plain"


def counted(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    inside = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)} if len(words) < 2000 else None
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), inside and len(inside) or 0


def test_quality_counts_equal_plain_python(docs):
    got = quality.measured(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        q = r["quality"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == counted(r["text"]), r["text"]


def test_repeated_words_in_long_and_random_texts(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) for n in range(9)] + [" ".join(rng.choice("abcdefgh") for _ in range(400)) for _ in range(20)]
    got = quality.measured(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")).collect()
    assert [r["quality"]["n_repeat_words"] for r in got] == [counted(t)[4] for t in texts]
    long = "v " * 400_000
    many = " ".join(f"w{i}" for i in range(200_000))
    a, b = quality.measured(spark.createDataFrame([(long,), (many,)], "text string")).collect()
    assert a["quality"]["n_repeat_words"] == 400_000 and b["quality"]["n_repeat_words"] == 0


def em_by_hand(votes, rounds=30, start=(0.95, 0.5), good=0.8, damp=10.0, least=0.1):
    k = len(votes[0])
    prior, g, b = good, [start[0]] * k, [start[1]] * k

    def posterior(v):
        odds = math.log(prior / (1 - prior)) + sum(
            math.log(g[j] / (1 - b[j])) if x == 1 else math.log((1 - g[j]) / b[j]) for j, x in enumerate(v) if x is not None)
        return 1 / (1 + math.exp(-odds))

    for _ in range(rounds):
        p = [posterior(v) for v in votes]
        part = lambda right, of, y: max(least, (sum(right) + damp * start[y]) / (sum(of) + damp))
        cast = [[(x[j], q) for x, q in zip(votes, p) if x[j] is not None] for j in range(k)]
        prior = (sum(p) + damp * good) / (len(p) + damp)
        g = [part([q for x, q in cast[j] if x == 1], [q for _, q in cast[j]], 0) for j in range(k)]
        b = [part([1 - q for x, q in cast[j] if x == 0], [1 - q for _, q in cast[j]], 1) for j in range(k)]
    return prior, g, b, posterior


def test_rule_accuracies_equal_plain_python(docs):
    rows = quality.measured(docs)
    cast = rows.select(F.array(*quality.votes(F.col("quality"))).alias("v"), quality.base_failed(F.col("quality")).alias("failed")).collect()
    prior, g, b, posterior = em_by_hand([tuple(r["v"]) for r in cast if not r["failed"]])
    p = [posterior(tuple(r["v"])) for r in cast]
    model = quality.fit_rules(rows)
    assert model.prior == pytest.approx(prior) and model.right_good == pytest.approx(g) and model.right_bad == pytest.approx(b)
    got = quality.judged(rows, model).collect()
    assert [r["quality"]["good_probability"] for r in got] == pytest.approx(p)
    for r, q in zip(got, p):
        n, *_, again = counted(r["text"])
        failed = n < 50 or 100 * again > 50 * n
        assert r["quality"]["base_failed"] == failed and r["quality"]["kept"] == (not failed and q >= 0.5)


def test_quality_of_an_empty_table(docs):
    none = quality.measured(docs.limit(0))
    model = quality.fit_rules(none)
    assert model.prior == pytest.approx(0.8) and quality.judged(none, model).count() == 0


def test_quality_agrees_with_labels_it_never_saw(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op12_quality_rules(spark, folder).where("not base_failed").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] == 1) for r in got) / len(got) > 0.95
    assert all(r["kept"] for r in got if r["quality"] == 1) or sum(r["kept"] for r in got if r["quality"] == 1) / sum(r["quality"] for r in got) > 0.98


# ------------------------------------------------------------------ conversations

GRAMMAR = re.compile(r"(s?(ua)+)?")


def fault_list(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All edits of a short conversation with up to two inserts in each gap."""
    best = None
    gaps = [()] + [c for k in (1, 2) for c in itertools.product("ua", repeat=k)]
    options = []
    for (role, text), fault in zip(rows, faults):
        extra = 3 * (fault == "truncated")
        own = [("D", 4, None)]
        if fault not in ("blank", "duplicate"):
            own += [("K", extra, (role[:1], f"{role}:{text}"))]
            own += [("R", 3 + extra, (r[0], f"{r}:{text}")) for r in ("user", "assistant")]
        options.append(own)
    names = {"u": "user", "a": "assistant"}
    for edits in itertools.product(*options):
        for fill in itertools.product(gaps, repeat=len(rows) + 1):
            audit, cost, roles, lines = "", 0, "", []
            for k in range(len(rows) + 1):
                for c in fill[k]:
                    audit, cost, roles = audit + "I", cost + 3, roles + c
                    lines.append(f"{names[c]}:")
                if k < len(rows):
                    letter, more, line = edits[k]
                    audit, cost = audit + letter, cost + more
                    if line:
                        roles += line[0] if line[0] in "sua" and line[0] else "?"
                        lines.append(line[1])
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, "\n".join(lines)
    return best


CONV = "conv_id bigint, turn bigint, role string, text string, copies int, cost int"


def conversations(spark, convs, copies=1):
    rows = [(c, i, role, text, copies, 9) for c, rows in enumerate(convs) for i, (role, text) in enumerate(rows)]
    return spark.createDataFrame(rows, CONV)


def test_repair_equals_exhaustive_search(spark):
    rng = random.Random(2)
    line = lambda: (rng.choice(["user", "assistant", "system", "tool", "user"]), rng.choice(["Hi.", "yes", " ", "", f"t{rng.random()}."]))
    convs = [[line() for _ in range(rng.randrange(1, 4))] for _ in range(60)]
    got = {r["conv_id"]: r for r in repair.repaired(conversations(spark, convs), Workspace(spark, "t"), block=2).collect()}
    for c, rows in enumerate(convs):
        faults = fault_list(rows)
        cost, audit, text = cheapest(rows, faults)
        r = got[c]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows
        assert (r["blank"], r["duplicate"], r["truncated"]) == tuple(faults.count(f) for f in repair.FAULTS[1:])
        kinds = "".join(x[0][:1] for x in rows)
        assert r["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))


def test_the_grammar_changes_no_matrix(spark):
    rng = random.Random(5)
    words = ["".join(chr(repair.BASE + rng.choice([0, 4, 8, 7, 5, 12])) for _ in range(rng.randrange(1, 40))) for _ in range(50)] + ["EI" * 300]
    rules, packed = repair.grammar(spark.createDataFrame([(w,) for w in words], "sequence string"), Workspace(spark, "t"))
    plain, ruled = repair.Matrices({}), repair.Matrices(rules)
    shown = lambda m: [[c and (c[0], str(c[1])) for c in row] for row in m]
    rows = packed.collect()
    assert rules and min(len(r["packed"]) for r in rows if len(r["sequence"]) == 600) < 100
    for r in rows:
        assert shown(plain.of(r["sequence"])) == shown(ruled.of(r["packed"]))


def test_a_long_conversation_is_cut_into_blocks(spark):
    rows = [("user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(3000)]
    rows[700], rows[1501] = ("tool", "x"), ("assistant", "turn 3.")
    r = repair.repaired(conversations(spark, [rows, rows[:2]]), Workspace(spark, "t"), block=64).where("conv_id = 0").first()
    assert r["audit"] == "K" * 700 + "R" + "K" * 800 + "D" + "I" + "K" * 1498 or r["cost"] == 6 + 7
    assert r["duplicate"] == 1 and r["truncated"] == 1 and r["gaps"] == 0


def test_many_equal_rows_are_one_run(spark):
    rows = conversations(spark, [[("user", "Hi."), ("assistant", "Ho.")]], copies=5000)
    r = repair.repaired(rows, Workspace(spark, "t"), block=100).first()
    assert (r["duplicate"], r["cost"], r["audit"]) == (9998, 4 * 9998, "K" + "D" * 4999 + "K" + "D" * 4999)


def test_awkward_conversations_equal_their_twin(spark, tmp_path):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "", None, "über", "tool"]),
             rng.choice([None, "", " \n", "A.", "B", "C!?", "é\tok. ", "long " * 2000])) for c in [None, *range(40)] for t in [None, -3, 0, 1, 1, 2, 2**40]]
    table = spark.createDataFrame(rows + rows[:9], "conv_id bigint, turn bigint, role string, text string")
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op13_conversations(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cur = con.execute(queries.ORACLE["op13_conversations"])
    names = [c[0] for c in cur.description]
    want = {r[names.index("conv_id")]: dict(zip(names, r)) for r in cur.fetchall()}
    rows = got.collect()
    assert len(rows) == len(want) == 41
    for r in rows:
        assert r.asDict() == want[r["conv_id"]]


def test_no_conversations(spark):
    none = conversations(spark, [[("user", "Hi.")]]).limit(0)
    assert repair.repaired(none, Workspace(spark, "t")).count() == 0
    left = repair.repaired(none, Workspace(spark, "t"), every=spark.createDataFrame([(3,), (3,)], "conv_id bigint")).collect()
    assert [r.asDict() for r in left] == [dict(conv_id=3, gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="",
                                              repaired_sha256=hashlib.sha256(b"").hexdigest())]


def test_repaired_rows_can_be_read(spark):
    rows = conversations(spark, [[("assistant", "Hi."), ("tool", "x.")]])
    work = Workspace(spark, "t")
    found = repair.audited(rows, work)
    out = repair.edited(rows, found.select("conv_id", "audit")).orderBy("place").collect()
    assert GRAMMAR.fullmatch("".join(r["role"][0] for r in out)) and [r["place"] for r in out] == list(range(len(out)))


def test_damage_follows_the_checksum(spark):
    rows = spark.createDataFrame([(c, t, "assistant", "Yes. No!") for c in range(30) for t in range(4)], "conv_id bigint, turn bigint, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in repair.damaged(rows).collect()}
    for c in range(30):
        for t in range(4):
            how = zlib.crc32(f"{c}:{t}".encode()) % 20
            r = got.get((c, t))
            assert (r is None) == (how == 0)
            if r:
                assert r["text"] == {1: "", 2: "Yes No"}.get(how, "Yes. No!") and r["role"] == ("user" if how == 4 else "assistant")
                assert r["copies"] == (2 if how == 3 else 1)
