"""Quality, conversation repair and spelling variants: odd tables, brute force, every path."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from compare import connect, differences
from ledgertie.llm import conversations, oracle, quality, spelling
from ledgertie.llm.text import as_bytes

SCHEMA = "doc_id long, text string, lang string, row int, n long, told int"
TURNS = "conv_id long, turn long, role string, text string, n long, chunk int"


# quality


def plain(text: str) -> dict[str, float]:
    words = text.split()
    lines = [line for line in text.split("\n") if line]
    pairs = list(itertools.pairwise(words))
    return {
        "bytes": np.log1p(len(text.encode())),
        "words": np.log1p(len(words)),
        "lines": np.log1p(len(lines)),
        "word_longest": np.log1p(max((len(w.encode()) for w in words), default=0)),
        "word_mean": sum(len(w.encode()) for w in words) / max(1, len(words)),
        "distinct_words": len(set(words)) / max(1, len(words)),
        "commonest_word": max((words.count(w) for w in words), default=0) / max(1, len(words)),
        "stuttered_words": sum(a == b for a, b in pairs) / max(1, len(words)),
        "distinct_pairs": len(set(pairs)) / max(1, len(pairs)),
        "distinct_lines": len(set(lines)) / max(1, len(lines)),
        "stopped_lines": sum(line[-1] in ".,;:!?" for line in lines) / max(1, len(lines)),
        "kinds": len(set(text.encode())),
        "digits": sum(c in "0123456789" for c in text) / max(1, len(text.encode())),
        "upper_words": sum(w.isalpha() and w.isascii() and w.isupper() and len(w) > 1 for w in words)
        / max(1, len(words)),
    }


def test_statistics_by_brute_force():
    draw = random.Random(2)
    bits = ["a", "bb", "CC", "7", "é", "d.", "\n", "\n\n", " ", "a", "x###"]
    texts = ["", "one", "\n", *(" ".join(draw.choices(bits, k=draw.randint(1, 60))) for _ in range(60))]
    got = quality.statistics(*as_bytes(pa.array(texts)))
    assert got.shape == (len(texts), len(quality.STATISTICS))
    for text, row in zip(texts, got, strict=True):
        for name, value in plain(text).items():
            assert row[quality.STATISTICS.index(name)] == pytest.approx(value, abs=1e-5), (name, text)


def slow_sense(forest: quality.Forest, x: np.ndarray) -> float:
    total = forest.base
    for node in forest.roots:
        for _ in range(quality.DEPTH):
            low = x[forest.statistic[node]] <= forest.threshold[node]
            node = forest.left[node] if low else forest.right[node]
        assert forest.left[node] == node
        total += forest.value[node]
    return total


def test_trees_learn_and_flat_arrays_agree_with_one_way_at_a_time():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(3000, 6)).astype(np.float32)
    x[:, 5] = 1.0  # a statistic that never differs
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    forest = quality.fit(x, y)
    senses = forest.senses(x)
    assert ((senses > 0) == (y > 0)).mean() > 0.99
    assert senses[:40] == pytest.approx([slow_sense(forest, row) for row in x[:40]])
    assert not (forest.statistic[forest.left != np.arange(len(forest.left))] == 5).any()


def test_quality_of_unseen_and_odd_documents(spark):
    draw = random.Random(9)
    rows, marks = [], []
    for i in range(900):
        words = [draw.choice(["alpha", "beta", "gamma", "delta", "of", "to"]) for _ in range(60)]
        if i % 3 == 0:
            words = [word + draw.choice(["###", "%%%"]) for word in words]
        rows.append((i, " ".join(words), None, 1, 2, 3))
        marks.append((i, int(i % 3 != 0)))
    rows += [(None, None, "en", 0, 0, 0), (5000, "", None, 0, 0, 0), (7, rows[7][1], None, 0, 0, 0)]
    rows += [(5001, "x" * 60_000, None, 0, 0, 0), (5002, "alpha " * 30_000, None, 0, 0, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame([*marks, (None, 1), (7, 0), (5, None), (8, 9)], "doc_id long, quality int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        held_out = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert (r.held_out, r.predicted) == (held_out, int(r.score >= 0.5))
    unseen = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(unseen) > 200
    assert sum(r.predicted == int(r.doc_id % 3 != 0) for r in unseen) >= 0.98 * len(unseen)
    assert len({r.score for r in got if r.doc_id == 7}) == 1
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.score_quality(empty, labels).count() == 0
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in quality.score_quality(docs, labels.filter("quality = 1")).collect()} == {1.0}


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    marks = {r.doc_id: r.quality for r in labels.collect()}
    scored = quality.score_quality(docs, labels).filter("held_out").collect()
    known = [r for r in scored if r.doc_id in marks]
    assert sum(r.predicted == marks[r.doc_id] for r in known) >= 0.95 * len(known)


# conversations


def least_repair(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Cost and letters by trying everything: rows of initial, must go, truncated."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    memo: dict = {}

    def rest(i: int, state: str, fuel: int) -> tuple[int, str] | None:
        if (i, state, fuel) in memo:
            return memo[i, state, fuel]
        ways = [(0, "")] if i == len(rows) and state in ("", "a") else []

        def way(cost: int, letter: str, j: int, to: str | None, left: int) -> None:
            after = rest(j, to, left) if to is not None else None
            if after is not None:
                ways.append((cost + after[0], letter + after[1]))

        if fuel:
            for role in "ua":
                way(3, "I", i, step.get((state, role)), fuel - 1)
        if i < len(rows):
            initial, dead, cut = rows[i]
            way(4, "D", i + 1, state, 2)
            if not dead:
                way(3 * cut, "K", i + 1, step.get((state, initial)), 2)
                for role in "ua":
                    way(3 + 3 * cut, "R", i + 1, step.get((state, role)), 2)
        memo[i, state, fuel] = min(ways, default=None)
        return memo[i, state, fuel]

    return rest(0, "", 2)


@pytest.mark.parametrize("size", [0, 1, 2, 5, 9, 14])
def test_chunks_give_the_least_repair(size):
    draw = random.Random(size)
    for _ in range(150):
        picked = [(draw.randrange(4), draw.choice([0, 0, 0, 1, 1, 2])) for _ in range(size)]
        rows = [{"code": 4 * initial + fault, "n": 1} for initial, fault in picked]
        told = [("suax"[initial], fault == 2, fault == 1) for initial, fault in picked]
        cut = draw.randint(0, size)
        parts = [rows[:cut], rows[cut:]]
        end = conversations.backward(parts[1], conversations.LAST)[-1]
        letters, _, state, cost = conversations.forward(parts[0], end, conversations.NOTHING)
        more, _, state, extra = conversations.forward(parts[1], conversations.LAST, state)
        tail = conversations.closing(state)
        audit, paid = letters + more + "I" * len(tail), cost + extra + 3 * len(tail)
        assert (paid, audit) == least_repair(told), told


def test_cost_vectors_forget_their_start():
    draw, ends = random.Random(1), [conversations.LAST, (0, 6, 3, 0), (0, 3, 0, 3), (4, 4, 7, 4)]
    forgot = 0
    for _ in range(200):
        rows = [{"code": 4 * draw.randrange(4) + draw.randrange(2), "n": 1} for _ in range(12)]
        forgot += len({conversations.backward(rows, end)[-1] for end in ends}) == 1
    assert forgot > 150
    assert conversations.before.cache_info().currsize < 5000


def odd_turns() -> list[tuple]:
    draw = random.Random(4)
    texts = ["One.", "two", "Three!", "", " \t", None, "four?\n", "é 中文 🎉.", "One.", "long " * 4000]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(draw.randint(1, 7)):
            role = draw.choice(["user", "assistant", "system", "user", "assistant", "tool", None, ""])
            rows.append((conv, draw.choice([turn, turn, turn, None, turn * 2]), role, draw.choice(texts), 1, 2))
    rows += [(50, t, "assistant" if t % 2 else "user", f"Turn {t}.", 0, 0) for t in range(400)]
    rows += [(51, t, draw.choice(["user", "assistant", "tool"]), draw.choice(texts), 0, 0) for t in range(300)]
    rows += [(52, t, "tool", f"cut {t}", 0, 0) for t in range(60)]  # rows that tell no states apart
    rows += [(53, 1, "user", "Same.", 0, 0)] * 40 + [(54, 0, "user", " ", 0, 0)] * 3
    return rows


@pytest.mark.parametrize("bits", [1, 3, conversations.CHUNK_BITS])
def test_repair_agrees_with_sql_on_odd_rows(spark, tmp_path, many_chunks, bits):
    turns = spark.createDataFrame(odd_turns(), TURNS)
    turns.coalesce(1).write.parquet(f"{tmp_path}/c")
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW conversations AS FROM read_parquet('{tmp_path}/c/*.parquet')")
    got = conversations.repair(turns.repartition(3), chunk_bits=bits)
    assert differences(got, con, oracle.statements()["op12_conversation_repair"]) == ""


def test_conversation_without_rows(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    turns = spark.createDataFrame([(gone, 0, "user", "Hi.", 0, 0)], TURNS)
    (row,) = conversations.repair(turns).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", nothing)
    assert conversations.repair(turns.limit(0)).count() == 0


# spelling


def slow_words(rows: list[tuple]) -> dict[str, int]:
    import re

    counts: dict[str, int] = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % spelling.ODDS == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(counts: dict[str, int]) -> dict[str, tuple]:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None

    def root(w: str) -> str:
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def odd_texts() -> list[tuple]:
    draw = random.Random(8)
    letters = "abcdeéÀß"
    stems = ["".join(draw.choices(letters, k=draw.randint(6, 9))) for _ in range(30)]
    stems += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ababab", "bababa", "prefixone", "prefixtwo"]
    rows = []
    for i in range(120):
        words = []
        for _ in range(60):
            word = stems[min(int(draw.expovariate(0.15)), len(stems) - 1)]
            at = draw.randrange(len(word))
            change = draw.randrange(12)
            if change == 0:
                word = word[:at] + word[at + 1 :]
            elif change == 1:
                word = word[:at] + draw.choice(letters) + word[at:]
            elif change == 2:
                word = word[:at] + draw.choice(letters) + word[at + 1 :]
            words.append(draw.choice([word, word, word.upper(), word.capitalize()]))
        rows.append((i, draw.choice([" ", "-", ", ", "ÿ×÷ 中"]).join(words)))
    long = "longrun" * 3000
    rows += [(None, rows[0][1]), (3, rows[1][1]), (3, rows[1][1]), (200, None), (201, ""), (202, "!")]
    chain = ["chainword"] * 150 + ["chainwor"] * 28 + ["chainwo"] * 5  # forms follow each other
    rows += [(400 + i, word) for i, word in enumerate(chain)]
    return [*rows, *((300 + i, f"{long} {long}") for i in range(4))]


def test_words_and_variants_by_brute_force(spark):
    rows = odd_texts()
    docs = spark.createDataFrame([(*row, None, 0, 0, 0) for row in rows], SCHEMA).repartition(3)
    got = {
        r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
        for r in spelling.spelling_variants(docs).collect()
    }
    want = slow_variants(slow_words(rows))
    assert got == want and len(want) > 100
    assert any(form is not None and root != form for form, root, *_ in want.values())
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [0, 3, 10_000])
def test_gram_lists_meet_for_every_near_pair(hot):
    """Whatever the dictionary: words that one edit apart share a list."""
    draw = random.Random(hot)
    words = {"".join(draw.choices("abc", k=draw.randint(6, 8))) for _ in range(700)}
    counts: dict[str, int] = {}
    for word in words:
        text = spelling.marked(word)
        for size in range(spelling.QMIN, spelling.QMAX + 1):
            for i in range(len(text) - size + 1):
                counts[text[i : i + size]] = counts.get(text[i : i + size], 0) + 1
    held = {g: n for g, n in counts.items() if len(g) == spelling.QMIN or counts[g[:-1]] > hot}
    held = {g: n for g, n in held.items() if len(g) < 4 or g[:-1] in held}
    grams = spelling.Grams(held)
    lists = {word: set(grams.listed(word)) for word in words}
    pairs = [(a, b) for a, b in itertools.combinations(sorted(words), 2) if one_edit(a, b)]
    assert len(pairs) > 500
    assert all(lists[a] & lists[b] for a, b in pairs)
