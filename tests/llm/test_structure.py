"""Whitening, manifests and chat windows against brute force, with nulls, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tessella.llm import chat, merkle, whitening


def vectors(rng, n, d=6):
    return [[float(np.float32(x)) for x in rng.normal(0, 0.1, d) * np.arange(1, d + 1)] for _ in range(n)]


def test_whitening_against_brute_force(spark):
    rng = np.random.default_rng(3)
    good = vectors(rng, 90)
    good += good[:20]  # repeated rows count as often as they occur
    rows = [(k, v, "x") for k, v in enumerate(good)] + [(1000, None, "x"), (1001, [0.1, None, 0.2, 0.3, 0.4, 0.5], "x"), (1002, [float("nan")] * 6, "x"), (1003, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], "x"), (1004, [], "x"), (1005, [0.5, 0.5], "x"), (None, good[0], None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, deviation string").repartition(5)
    found = whitening.whiten(df, components=8)
    assert found.columns == ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
    out = {r.vec_id: r for r in found.collect()}
    assert set(out) == {*range(110), None}
    deviations, white, explained = whitening.brute_force([*good, good[0]])
    assert [out[k].deviation for k in range(110)] == deviations[:110] and out[None].deviation == deviations[0]
    assert np.allclose(np.abs([out[k].whitened for k in range(110)]), white[:110], rtol=1e-9, atol=1e-9)
    assert np.allclose(out[0].explained, explained, rtol=1e-12) and out[0].n == 111
    assert 0 <= out[5].identity_error < 1e-9
    w = np.array([r.whitened for r in out.values()])
    assert abs(np.cov(w.T, bias=True) - np.eye(6)).max() < 1e-9
    again = {r.vec_id: r.whitened for r in whitening.whiten(df.repartition(2)).collect()}
    assert again == {k: r.whitened for k, r in out.items()}  # the sums are exact, so the order of rows makes no difference


def test_whitening_of_little_and_of_large(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert whitening.whiten(empty).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], "vec_id bigint, embedding array<float>")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, [None, None], [None, None], None)]
    # One direction varies only; entries far beyond those of embeddings stay exact.
    big = [[1e12, 3.0], [-1e12, 3.0], [5e11, 3.0], [1e300, 3.0]]
    rows = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(list(enumerate(big)), "vec_id bigint, embedding array<double>")).collect()}
    x = [[min(int(np.floor(c * 1024)), whitening.LIMIT) + 100_000 for c in v] for v in big]
    s = [sum(v[k] for v in x) for k in range(2)]
    assert [int(rows[k].deviation) for k in range(4)] == [sum((4 * v[k] - s[k]) ** 2 for k in range(2)) for v in x]
    assert rows[0].whitened[1] is None and rows[0].whitened[0] is not None and rows[0].identity_error < 1e-9


def test_bit_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for bits, rows in ((1, 64), (11, 200), (45, 77)):
        x = rng.integers(0, 1 << bits, (rows, 5))
        total = np.zeros((whitening.LIMBS, 5, 5), np.int64)
        for part in (x[:33], x[33:]):
            whitening.add_products(total, part, bits)
        whole = [[sum(int(total[k, a, b]) << (whitening.LIMB * k) for k in range(whitening.LIMBS)) for b in range(5)] for a in range(5)]
        assert all(whole[a][b] == sum(int(r[a]) * int(r[b]) for r in x) for a in range(5) for b in range(a, 5))


def documents(spark, n, sources=40):
    rng = random.Random(n)
    rows = []
    for k in range(n):
        source = None if k % 41 == 0 else "big" if k % 3 == 0 else f"s{k % sources}" if k % 7 else "ärger"
        text = rng.choice([None, "", "plain", "Some TEXT ß", "UPPER " * rng.randrange(50)])
        rows.append((k, source, rng.choice(["en", None]), rng.choice([None, len(text or "")]), text))
    rows.append((None, "big", None, None, None))
    return rows


def test_manifest_against_brute_force(spark):
    for n in (1, 17, 2500):
        rows = documents(spark, n)
        # Names of results and of helpers as columns of the input.
        df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(7).withColumns({c: F.lit("clash") for c in ("leaf", "root", "list", "_key", "digest", "at")})
        change = [r[0] is not None and r[0] % 5 == 0 for r in rows]
        text = F.when(F.col("doc_id") % 5 == 0, merkle.lowered(F.col("text"))).otherwise(F.col("text"))
        found = merkle.manifest(df, candidate=merkle.leaf([*map(F.col, merkle.FIELDS[:-1]), text]), proofs=True).collect()
        assert sorted([tuple(r)[:7] for r in found], key=repr) == sorted(merkle.brute_force(rows, change), key=repr)
        for r in found:  # a proof is enough to verify a row
            path = [(s.before, s.after) for s in r.proof]
            assert merkle.fold(r.leaf, path) == r.root and r.proof_sha256 == merkle.sha256("".join(b + a for b, a in path))
    assert any(not r.verified for r in found) and any(r.verified for r in found)


def test_manifest_beyond_one_superblock_of_roots(spark):
    """Superblocks of one level, so that the list of their roots is reduced in passes too."""
    rows = [(k, "a" if k % 9 else None, None, k, "T" * (k % 5)) for k in range(700)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    found = merkle.manifest(df, height=1).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(merkle.brute_force(rows, [False] * len(rows)), key=repr)
    assert all(r.verified for r in found)


def test_manifest_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a", "x")] * 3 + [(1, "a", "y")], "doc_id bigint, source string, text string")
    found = merkle.manifest(df, columns=("doc_id", "source", "text")).collect()
    assert len(found) == 4 and all(r.verified for r in found) and len({r.root for r in found}) == 1
    assert merkle.manifest(df.limit(0), columns=("doc_id",)).count() == 0


WORDS = ["alpha", "be##ta", "</turn>", "\\", "###", "#### user: ", "\n", "ß", "<\\/turn>", "\\#", "12", "😀", ": "]


def conversations():
    rng = random.Random(5)
    rows = []
    for conv in range(40):
        for turn in range(rng.choice([0, 1, 2, 5, 9, 150 if conv % 20 == 3 else 7])):
            role = rng.choice(["user", "assistant", "assistant", "system", "tool: x", None]) if conv % 4 else ["user", "assistant"][turn % 2]
            text = " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 3, 20, 60, 400]))) if rng.random() < 0.95 else None
            text = f"{turn} {text}" if role == "system" else text  # so that system turns can be told apart below
            rows.append((conv if conv != 7 else None, turn, role, text))
    rows += [(50, None, "user", "first"), (50, 0, "assistant", "twice"), (50, 0, "assistant", "twice"), (50, -1, "system", "be"), (51, 0, "system", "word " * 900), (51, 1, "user", "q"), (51, 2, "assistant", "a"), (52, 0, "assistant", "x" * 200_000)]
    return rows


def test_chat_windows_read_back(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(6).withColumns({c: F.lit("clash") for c in ("window", "_at", "loss", "tokens")})
    budget, history = 300, 80
    windows = chat.chat_windows(df, budget, history)
    read = windows.select("*", chat.turns_of(F.col("formatted")).alias("read"), chat.loss_texts(F.col("formatted"), F.col("loss")).alias("lost")).collect()
    count = lambda text: len(re.findall(r"[^\W\d_]+|\d|[^\w\s]|_", text)) + chat.MARKS
    convs = {}
    for r in sorted(read, key=lambda r: (repr(r.conv_id), r.window)):
        convs.setdefault(r.conv_id, []).append(r)
    by_conv = {}
    for r in rows:
        by_conv.setdefault(r[0], []).append(r)
    assert set(convs) == set(by_conv)
    for conv, members in by_conv.items():
        turns = [(r[2] or "", r[3] or "") for r in sorted(members, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))]
        fresh = [(t.role, t.text) for r in convs[conv] for t in r.read[r.repeated :]]
        assert fresh == turns
        assert [t for r in convs[conv] for t in r.lost] == [t for role, t in turns if role == "assistant"]
        system = next(((r, t) for r, t in turns if r == "system"), None)
        done = 0
        for r in convs[conv]:
            seen = [(t.role, t.text) for t in r.read]
            assert len(seen) == r.turns and (system is None or system in seen)
            old = seen[: r.repeated]
            if system is not None and system not in seen[r.repeated :]:
                assert old.pop(0) == system
            # What is repeated is the end of what went before: turns that begin at most ``history`` tokens earlier, without the system turn.
            before, near = 0, []
            for turn in reversed(turns[:done]):
                before += count(turn[1])
                if before <= history and turn != system:
                    near.insert(0, turn)
            assert old == near
            done += len(seen) - r.repeated
            own = [count(t) for _, t in seen[r.repeated :]]
            limit = max(budget // 4, budget - history - (count(system[1]) if system else 0))
            assert sum(own) <= limit or len(own) == 1
            assert r.tokens == sum(count(t) for _, t in seen)
    assert max(len(c) for c in convs.values()) > 10 and any(r.repeated > 1 for r in read)
    assert chat.chat_windows(df.limit(0)).count() == 0


def test_chat_escapes_are_reversible(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["#", "\\", "<", "/", "turn>", "</turn>", "a", "\n", "###"]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e")).select("t", "e", chat.unescaped(F.col("e")).alias("u"))
    for r in df.collect():
        assert r.u == r.t and "###" not in r.e and "</turn>" not in r.e


def test_chat_query_of_the_hostile_conversation(spark, sf):
    row = chat.op13_chat_format(spark, sf).filter("conv_id = -7").first()
    text = r"\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(text)
    assert row.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
