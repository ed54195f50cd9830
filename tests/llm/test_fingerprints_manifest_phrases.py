"""SimHash groups, the manifest and collocations against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from waybill.llm import merkle, phrases, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns that operators use inside.
CLASH = ["node", "ids", "point", "least", "comp", "hash", "tree", "pos", "n", "kids", "folds", "leaf", "root", "a", "f", "number", "phrase", "rank"]


def clashing(df):
    return df.withColumns({name: F.lit("x") for name in CLASH})


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def linked_groups(rows):
    prints = [fingerprint(t) for _, t in rows]
    known, parent = sorted(set(prints)), {p: p for p in prints}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[top(a)] = top(b)
    least = {}
    for (doc_id, _), p in zip(rows, prints, strict=True):
        if doc_id is not None:
            least[top(p)] = min(least.get(top(p), doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(top(p))) for (d, _), p in zip(rows, prints, strict=True)), key=repr)


@pytest.mark.parametrize("crowd", [simhash.CROWD, 2])
def test_simhash_groups_are_brute_forces(spark, crowd):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(50)] + ["Éa", "AB", "中文"]
    texts = [None, "", " \t", "a", "A", "a b", "x " * 3000, "y" * 50_000]
    for size in [1, 2, 3, 4, 6, 60, 200] * 4:
        text = [rnd.choice(words) for _ in range(size)]
        for _ in range(8):
            near = list(text)
            near[rnd.randrange(size)] = rnd.choice(words)
            texts.append(rnd.choice([" ", "\n"]).join(near))
    texts += texts[:30]
    rows = [(rnd.choice([i, i, None, 7]), t) for i, t in enumerate(texts)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = sorted(map(tuple, simhash.groups(df, crowd=crowd).collect()), key=repr)
    assert got == linked_groups(rows)
    assert len({r[2] for r in got}) < len({r[1] for r in got})


def test_grid_distance_is_at_most_the_bits():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 63, 3000, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rnd.integers(0, 64, 3000, dtype=np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 64, 3000, dtype=np.uint64))
    x, y = ([simhash.grid(v) >> np.uint64(2 * i) & np.uint64(3) for i in range(32)] for v in (a, b))
    apart = sum(np.abs(p.astype(int) - q.astype(int)) for p, q in zip(x, y, strict=True))
    assert (apart <= np.bitwise_count(a ^ b)).all()
    assert all(int(sum(p[i] for p in x)) == int(a[i]).bit_count() for i in range(100))


def test_crowds_and_points_across_batches():
    """Rows of a point that end one batch and begin the next meet, in crowds too."""
    node = np.array([0, 1, 2, 4, 8, 7, 7 << 40, 3], dtype=np.int64)
    for crowd in (1, 2, 3, 100):
        for cut in range(9):
            both = [pa.RecordBatch.from_arrays([pa.array(np.zeros(len(p), dtype=np.int64)), pa.array(p)], names=["point", "node"]) for p in (node[:cut], node[cut:])]
            rows = [r for b in simhash._met(iter(both), crowd) for r in b.to_pylist()]
            groups = [{int(n)} for n in node]
            points = defaultdict(set)
            for r in rows:
                points[r["a"] if r["finer"] else ("edge", r["a"], r["b"])] |= {r["b"]} if r["finer"] else {r["a"], r["b"]}
            for met in points.values():
                joined = set().union(*[g for g in groups if g & met])
                groups = [g for g in groups if not g & met] + [joined]
            assert sorted(map(sorted, groups)) == [[0, 1, 2, 3, 4, 7, 8], [7 << 40]], (crowd, cut)


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def proofs(rows):
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)

    def build(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def siblings(levels, i):
        for level in levels[:-1]:
            run = i // 16 * 16
            yield level[run:i], level[i + 1 : run + 16]
            i //= 16

    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        sources[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = [build([leaf(r, r[4]) for r in sources[name]]) for name in names]
    top = build([tree[-1][0] for tree in trees])
    for k, (name, tree) in enumerate(zip(names, trees, strict=True)):
        for i, row in enumerate(sources[name]):
            path = [*siblings(tree, i), *siblings(top, k)]
            drawn = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            fold = leaf(row, row[4].translate(LOWER) if drawn else row[4])
            for before, after in path:
                fold = H(*before, fold, *after)
            root = top[-1][0]
            proof = H(*(d for before, after in path for d in before + after))
            yield row[0], leaf(row, row[4]), tree[-1][0], root, proof, fold, fold == root


@pytest.mark.parametrize(("rows", "sources"), [(0, 1), (1, 1), (16, 1), (18, 1), (290, 2), (500, 40), (6, 6)])
def test_manifest_is_brute_forces(spark, rows, sources):
    rnd = random.Random(rows)
    docs = []
    for i in range(rows):
        source = rnd.choice([None, "", "é", *(f"s{j}" for j in range(sources))]) if sources > 1 else "one"
        text = rnd.choice([None, "", "Ab Cé", "xyz", "É", "Q" * 5000])
        docs.append((rnd.choice([i, i, i, None, 3]), source, rnd.choice(["en", None]), rnd.choice([None, 5]), text))
    docs += docs[:3] if rows > 1 else []
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    got = sorted(map(tuple, merkle.manifest(clashing(df)).collect()), key=repr)
    assert got == sorted(proofs(docs), key=repr)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def collocations(rows, least, top):
    counts, total, found = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        kept, longest = {p: a for p, a in f.items() if len(p) > 1 and a >= least}, Counter()
        for p, a in kept.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longest[p[i : i + k]] = max(longest[p[i : i + k]], a)
        best = []
        for p, a in kept.items():
            if 100 * longest[p] < 80 * a:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(found)


@pytest.mark.parametrize(("least", "top", "shard"), [(30, 2000, phrases.SHARD), (4, 40, 100), (1, 5000, phrases.SHARD)])
def test_collocations_are_brute_forces(spark, least, top, shard):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(12)] + ["É", "A", "a", "x　y", "\x00"]
    rows = [(None, "z" * 30_000 + " " + "z " * 300), ("en", None), ("en", ""), ("en", " ... \n")]
    for _ in range(300):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", ""]) for _ in range(rnd.choice([0, 1, 5, 80])))
        rows.append((rnd.choice(["en", "de", None, "und"]), rnd.choice([text, text, text, None, "big bad wolf ate " * 3])))
    df = clashing(spark.createDataFrame(rows, "lang string, text string").repartition(4))
    got = sorted(map(tuple, phrases.collocations(df, least=least, top=top, shard=shard).collect()))
    assert got == collocations(rows, least, top)


def test_no_texts_give_no_groups_proofs_or_phrases(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert not simhash.groups(empty).collect() + merkle.manifest(empty).collect() + phrases.collocations(empty).collect()


def test_double_array_finds_its_phrases_only():
    rnd = random.Random(5)
    words = [f"v{i}" for i in range(3000)]
    known = sorted({" ".join(rnd.choice(words[: rnd.choice([3, 3000])]) for _ in range(rnd.randint(2, 4))) for _ in range(5000)})
    langs = [rnd.choice(["en", "de"]) for _ in known]
    trie = phrases.PhraseTrie(np.arange(len(known)) + 7, pa.array(langs), pa.array(known))
    for lang in ("en", "de", "fr"):
        batch = pa.RecordBatch.from_arrays([pa.array([lang] * len(known)), pa.array(known)], names=["lang", "text"])
        want = Counter()
        for text in known:
            parts = text.split(" ")
            want.update(" ".join(parts[i:j]) for i in range(len(parts)) for j in range(i + 2, len(parts) + 1))
        counts = trie.count(phrases.Words(batch))
        assert [int(c) for c in counts] == [want[p] if at == lang else 0 for p, at in zip(known, langs, strict=True)]


def test_phrase_counting_makes_a_row_per_place_not_per_task_and_phrase():
    """Each chunk gives one row per place found, so the rows grow with the text, not tasks times phrases."""
    known = ["a b", "b c", "a b c"]
    trie = phrases.PhraseTrie(np.array([10, 11, 12]), pa.array(["en"] * 3), pa.array(known))
    texts = ["a b c. a b", "x y", "b c b c"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array(texts)], names=["lang", "text"])
    made = list(phrases._phrase_places(type("B", (), {"value": trie})())(iter([batch])))
    assert [b.schema.names for b in made] == [["number"]]
    assert sorted(made[0].column("number").to_pylist()) == [10, 10, 11, 11, 11, 12]
