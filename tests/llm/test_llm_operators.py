"""Every operator against brute force, on small tables with nulls, ties, repeats and odd columns."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from waybill.llm import bpe, jaccard, language, licenses, mixing, neighbours, prefix, quality, repeats, secrets

BLANK = "[^\\x20\\x09-\\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key int, row string, n int"


def table(spark, texts, ids=None):
    """Documents with columns whose names operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [
        (i, t, ("en", "de", None)[k % 3], (None, "b", "a")[k % 3], None, 1, "x", None)
        for k, (i, t) in enumerate(zip(ids, texts))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(seed=0):
    """Short texts with copies, near copies, shared passages, repeated lines, blanks and nulls."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Éa", "中文", "&&&", "|", "don't"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 5, 30, 120]))) for _ in range(60)]
    passage = " ".join(rnd.choice(words) for _ in range(40))
    for i in range(0, 20, 2):
        texts[i] += " " + passage + "\n" + texts[i + 1]
    for t in texts[20:30]:
        copy = t.split(" ")
        copy[len(copy) // 2] = "changed"
        texts += [t, " ".join(copy), t + " more"]
    return texts + [None, "", " \t\n", "\n\n", "a", "A  a\x0bA", "same line\nsame line\nsame line", "x " * 300]


def blank_words(text):
    return re.findall(BLANK, text or "")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def tricky(seed, n):
    rnd = random.Random(seed)
    parts = list("abtse1'!. \n\t") + ["'s", "'re", "'ll", " ", "　", "é", "中", "😀", "  ", "ing", "\r\n", "▁", "\x00"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def test_bpe_is_the_librarys_and_decodes(spark, ranks):
    import tiktoken

    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = [None, "", "a" * 5000, "ab " * 3000, "<|endoftext|>", *tricky(1, 400), *corpus()]
    for pattern in (None, public_tokenizers.PATTERN):
        coded = bpe.decode(bpe.encode(table(spark, texts), ranks, pattern), ranks).collect()
        for row in coded:
            assert row.ids == known.encode_ordinary(row.text or "")
            assert row.decoded.decode() == (row.text or "")
            assert row.key == 1
    with pytest.raises(ValueError):
        bpe.RankMap({b"a": 0})


def test_bpe_of_an_empty_table(spark, ranks):
    assert bpe.decode(bpe.encode(table(spark, []), ranks), ranks).count() == 0


def test_tokens_stage_decodes(spark):
    import hashlib

    import corpus_pipeline

    texts = [None, "", "é 中文 😀 \r\n x\x00", *tricky(3, 50), *corpus()[:20]]
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.tokens(spark, table(spark, texts), "").collect()}
    assert got == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}


def test_prefix_counts_are_the_librarys(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    known, pieces = sentencepiece.SentencePieceProcessor(model_file=path), prefix.vocabulary(path)
    texts = [None, "", " " * 50, "a" * 300, "<s> </s>", *tricky(2, 300), *corpus()[:20]]
    for row in prefix.count_tokens(table(spark, texts), pieces, 7, prefixes=True).collect():
        text = row.text or ""
        want = [len(known.encode(text[:i])) for i in range(1, len(text) + 1)]
        assert (row.prefix_tokens, row.n_tokens) == (want, len(known.encode(text)))
        assert row.n_bytes == len(text.encode())
        assert row.fit_chars == max((i for i, n in enumerate(want, 1) if n <= 7), default=0)
    assert prefix.count_tokens(table(spark, []), pieces, 7).count() == 0


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((1500, 16))
    vectors[1000:1400] = vectors[0]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    odd = [(2000, None, ""), (2020, [0.0] * 16, ""), (2040, [float("nan")] * 16, ""), (2060, [None] * 16, ""), (None, [1.0] * 16, "")]
    data = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, block string")
    found = neighbours.search(data, F.col("vec_id") % 20 == 0, 20, block_rows=400).collect()
    exact = np.array([np.float32(v) for v in vectors], dtype=np.float64)
    by_query, hit = {}, 0
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(by_query) == list(range(0, 1500, 20))
    for q, got in by_query.items():
        scores = exact @ exact[q]
        best = sorted((i for i in range(1500) if i != q), key=lambda i: (-scores[i], i))[:20]
        hit += len(set(best) & {i for i, _ in got})
        assert got == sorted(got, key=lambda x: (-x[1], x[0])) and len(got) == 20
        assert np.allclose([s for _, s in got], [scores[i] for i, _ in got], rtol=1e-12)
    assert hit >= 0.95 * 20 * len(by_query)
    few = spark.createDataFrame(rows[:3], data.schema)
    assert neighbours.search(few, F.col("vec_id") % 20 == 0, 20).count() == 2
    assert neighbours.search(data.filter("false"), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_language_by_all_segmentations(spark):
    from waybill.llm.queries import letter_pieces

    import pyarrow as pa

    pieces = language.Pieces(letter_pieces())
    rng = np.random.default_rng(0)
    chances = rng.random((pieces.size, 2))
    model = language.Model(pieces, ["a", "b"], chances / chances.sum(axis=0))
    words = language.Words(pieces, pa.array(["Straße zu x"]))
    logs = model.word_logs(words)[words.word]
    of = {}
    for letters, number in _spelled(pieces):
        of[letters] = number
    for text, got in zip(["straße", "zu", "x"], logs):
        coded = [int(pieces.letter[ord(c)]) for c in "▁" + text]
        total = [np.ones(2)]
        for i in range(1, len(coded) + 1):
            total.append(sum((total[j] * model.chances[of[tuple(coded[j:i])]] for j in range(i) if tuple(coded[j:i]) in of), np.zeros(2)))
        assert np.allclose(got, np.log(total[-1]))


def test_language_of_long_runs_by_all_segmentations():
    import pyarrow as pa

    from waybill.llm.queries import letter_pieces

    pieces = language.Pieces(letter_pieces())
    rng, rnd = np.random.default_rng(1), random.Random(1)
    chances = rng.random((pieces.size, 2)) ** 4
    model = language.Model(pieces, ["a", "b"], chances / chances.sum(axis=0))
    of = dict(_spelled(pieces))
    parts = ["house", "garten", "straße", "the", "und", "中文", "xq", "ation"]
    texts = ["".join(rnd.choice(parts) for _ in range(n)) for n in (1, 8, 12, 13, 40, 300)] + ["x"]
    texts += [texts[-2][:n] for n in (31, 32, 33, 47, 48, 49, 63, 64, 65, 1000)]
    words = language.Words(pieces, pa.array([" ".join(texts)]))
    with np.errstate(divide="ignore"):
        for text, got in zip(texts, model.word_logs(words)[words.word], strict=True):
            coded = [int(pieces.letter[ord(c)]) for c in "▁" + text]
            total = [np.zeros(2)]
            for i in range(1, len(coded) + 1):
                ways = [(total[j], of.get(tuple(coded[j:i]))) for j in range(max(0, i - pieces.trie.longest), i)]
                total.append(np.logaddexp.reduce([t + np.log(model.chances[p]) for t, p in ways if p is not None]))
            assert np.allclose(got, total[-1], rtol=1e-10)


def _spelled(pieces):
    """All pieces with their letters, read off the trie."""
    table_, ends = pieces.trie.step, pieces.trie.ends
    entries = [int(e) for e in table_.entries if e >= 0]
    parent = {e & 0xFFFFF: ((e >> 20) >> 17, (e >> 20) & 0x1FFFF) for e in entries}
    for node, number in enumerate(ends):
        letters, at = [], node
        while at:
            at, letter = parent[at]
            letters.append(letter)
        if number >= 0:
            yield tuple(letters), int(number)


def test_language_predictions(spark):
    from waybill.llm.queries import letter_pieces

    english = ["the house and the garden", "with this and that for you", "when they were there"] * 4
    german = ["das haus und der garten", "mit dem und nicht für dich", "wenn sie nicht dort waren"] * 4
    rows = [(i, t, l, 1) for i, (t, l) in enumerate([(t, "en") for t in english] + [(t, "de") for t in german])]
    rows += [(100, None, None, 1), (101, "123 %", None, 1), (102, "", "en", 1), (None, "und das haus", None, 1), (None, "and the house", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, piece int")
    model = language.learn(docs.filter(~language.held_out(F.col("doc_id"))), letter_pieces())
    got = language.predict(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in got if r.lang and r.text)
    assert [r.lang_pred for r in got[-2:]] == ["de", "en"]
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id and 99 < r.doc_id < 103)
    assert all(0 <= r.score <= 1 for r in got)
    nothing = language.learn(docs.filter("false"), letter_pieces())
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(docs.filter("false"), model).count() == 0


def test_licenses(spark):
    words = licenses.TEXTS["mit"].split()
    cut = " ".join(words[:40] + ["extra", "words"] + words[45:])
    texts = [None, "", "Under the MIT License, and under the mit license", "under the mit", "CC BY-NC x", cut, "x " * 50]
    ids = [3, 4, None, 6, 7, 8, 8]
    got = licenses.scan(table(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    by = {(r.doc_id, r.n_words): r for r in got}
    assert (by[None, 9].n_base, by[None, 9].first_word, by[None, 9].last_word, by[None, 9].labels) == (2, 0, 5, "mit")
    assert (by[7, 4].base_labels, by[6, 3].labels, by[3, 0].labels, by[4, 0].first_word) == ("cc-by-nc", "", "", None)
    long = [r for r in got if r.doc_id == 8 and r.n_words > 60][0]
    assert (long.n_base, long.base_labels, long.labels) == (0, "", "mit") and 0.6 < long.score < 1
    assert licenses.scan(table(spark, [])).count() == 0


def test_license_texts_have_their_own_label_only(spark):
    around = " ".join(f"w{i}" for i in range(30))
    names = sorted(licenses.TEXTS)
    texts = [licenses.TEXTS[n] for n in names] + [f"{around} {licenses.TEXTS[n]} {around}" for n in names]
    want = names * 2
    for a, b in (("cc-by", "cc-by-nc"), ("cc-by-nc", "cc-by"), ("mit", "isc")):  # two notices, one after the other
        texts.append(f"{licenses.TEXTS[a]} {licenses.TEXTS[b]}")
        want.append(",".join(sorted([a, b])))
    for n in ("cc-by", "cc-by-nc"):  # without the address
        texts.append(licenses.TEXTS[n].split(" http")[0])
        want.append(n)
    texts.append(licenses.TEXTS["cc-by"] + " CC BY-NC")  # a phrase stays whatever is beside it
    want.append("cc-by,cc-by-nc")
    got = {r.doc_id: r for r in licenses.scan(table(spark, texts)).collect()}
    assert [got[i].labels for i in range(len(texts))] == want
    assert all({s.label for s in r.spans} == set(r.labels.split(",")) for r in got.values())


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = tuple(blank_words(lower))
    return {words} - {()} if len(words) < 3 else {words[i : i + 3] for i in range(len(words) - 2)}


@pytest.mark.parametrize("seed", [0, 1])
def test_jaccard_components_against_all_pairs(spark, seed):
    rnd, texts = random.Random(seed), corpus(seed)
    base = [f"t{i}" for i in range(200)]
    for _ in range(40):  # chains of near copies
        base[rnd.randrange(200)] = f"n{rnd.random()}"
        texts.append(" ".join(base))
    ids = [None if i % 17 == 0 else i // 2 * 2 if i % 11 == 0 else i for i in range(len(texts))]
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        return i if label[i] == i else root(label[i])

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 90 * len(a | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        r = root(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    want = Counter((d, len(s), least[root(i)] if s else d) for i, (d, s) in enumerate(zip(ids, sets)))
    docs = table(spark, texts, ids).drop("row").withColumn("row", F.monotonically_increasing_id())
    got = jaccard.groups(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    full = {root(i) for i, s in enumerate(sets) if s}
    assert sum(r["first"] for r in got) == len(full) + sum(not s for s in sets)


def test_near_copies_stage_against_all_pairs(spark):
    import corpus_pipeline

    rnd, texts = random.Random(6), corpus(6)
    for k in range(30):  # copies with a few changed words: five-word Jaccard about 0.75 to 0.95
        base = [f"c{k}-{i}" for i in range(100)]
        texts.append(" ".join(base))
        for at in rnd.sample(range(5, 95, 6), 1 + k % 3):
            base[at] = f"n{rnd.random()}"
        texts.append(" ".join(base))
    sets = []
    for t in texts:
        words = tuple(blank_words(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
        sets.append({words[i : i + 5] for i in range(max(1, len(words) - 4))} - {()})
    label = list(range(len(texts)))

    def root(i):
        return i if label[i] == i else root(label[i])

    between = 0
    for i, a in enumerate(sets):
        for j in range(i):
            common, union = len(a & sets[j]), len(a | sets[j])
            if a and sets[j] and 100 * common >= 80 * union:
                between += 100 * common < 90 * union
                low, high = sorted((root(i), root(j)))
                label[high] = low
    assert between >= 10
    docs = table(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    kept = [r.doc_id for r in corpus_pipeline.one_of_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == [i for i, s in enumerate(sets) if root(i) == i or not s]


def test_jaccard_of_an_empty_table(spark):
    assert jaccard.groups(table(spark, []).withColumn("row", F.lit(1))).count() == 0


def test_count_tree_finds_all_pairs():
    rng = np.random.default_rng(5)
    points = rng.poisson(6, (700, jaccard.GROUPS)).astype(np.int32)
    points[300:] = np.maximum(points[:400] + rng.integers(-1, 2, (400, jaccard.GROUPS)), 0)
    a, b = jaccard.CountTree(points).pairs()
    common = np.array([np.minimum(points, p).sum(axis=1) for p in points])
    size = points.sum(axis=1)
    want = 190 * common >= 90 * (size[:, None] + size)
    assert {(min(x), max(x)) for x in zip(a.tolist(), b.tolist())} == {(i, j) for i, j in zip(*np.nonzero(want)) if i < j}


def test_mixing_meets_targets(spark):
    texts = [t for s in range(6) for t in corpus(s)]
    docs = table(spark, texts)
    runs = []
    for parts in (1, 7):
        measured = mixing.measure(docs.repartition(parts))
        runs.append(mixing.take(measured, mixing.plan(measured)).collect())
    assert {(r.doc_id, r.taken) for r in runs[0]} == {(r.doc_id, r.taken) for r in runs[1]}
    total = sum(len(blank_words(t)) for t in texts)
    by = {}
    for r in runs[0]:
        assert r.size == len(blank_words(r.text)) and r.taken in (0, r.size, 2 * r.size)
        by.setdefault(r.source, []).append(r)
    assert sum(rows[0].target for rows in by.values()) == pytest.approx(1.5 * total)
    longest = max(r.size for r in runs[0])
    for rows in by.values():
        assert rows[0].source_size == sum(r.size for r in rows)
        assert rows[0].target <= 2 * rows[0].source_size
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= longest
    empty = mixing.measure(docs.filter("false"))
    assert mixing.take(empty, mixing.plan(empty)).count() == 0
    blank = mixing.measure(table(spark, [None, ""]))
    assert [r.taken for r in mixing.take(blank, mixing.plan(blank)).collect()] == [0, 0]


def test_quality_rules(spark):
    texts = corpus(4) + ["a b c d e f g a b c d e f g x", None]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)] + [(1, 1, 0), (None, 1, 0), (12, 1, None), (13, None, 0)], "doc_id long, quality int, toxic int")
    trusted = quality.trusted_ids(labels)
    assert {r.doc_id for r in trusted.collect()} == {*range(10), 12}
    logs = quality.weights(docs, trusted)
    for r in quality.rules(docs, logs).collect():
        words = blank_words(r.text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in (r.text or "").split("\n") if blank_words(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert (r.n_dup_lines, r.n_symbols) == (len(lines) - len(set(lines)), len(re.findall("[#*$%&|<>]", r.text or "")))
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)
    assert quality.weights(docs, trusted.filter("false")) == [0.0] * quality.BUCKETS
    assert quality.rules(docs.filter("false"), logs).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_repeats_against_all_windows(spark, seed):
    texts = corpus(seed) + ["z " * 100 + "end", "z " * 90]
    ids = [None if i % 13 == 0 else i // 2 * 2 if i % 7 == 0 else (i * 37) % 101 for i in range(len(texts))]
    first = {}
    for d, t in zip(ids, texts):
        words = blank_words(t)
        for i in range(len(words) - 12):
            first[tuple(words[i : i + 13])] = min(first.get(tuple(words[i : i + 13]), 1 << 62), 1 << 62 if d is None else d)
    want = Counter()
    for d, t in zip(ids, texts):
        words, gone = blank_words(t), set()
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < (1 << 62 if d is None else d):
                gone |= set(range(i, i + 13))
        want[d, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)] += 1
    docs = table(spark, texts, ids).drop("row").withColumn("row", F.monotonically_increasing_id())
    got = repeats.remove(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == want
    assert repeats.remove(docs.filter("false")).count() == 0


def test_equal_windows_get_equal_symbols():
    import pyarrow as pa

    from waybill.llm.common import flat_text

    rnd = random.Random(8)
    texts = [" ".join(rnd.choice("abcd") for _ in range(400)) for _ in range(40)]
    words, first = jaccard.word_hashes(*flat_text(pa.array(texts)), lower=False)
    starts, key, digest = repeats.window_keys(words, first)
    known = {}
    for s, k, d in zip(starts.tolist(), key.tolist(), digest.tolist()):
        assert known.setdefault(tuple(words[s : s + 13].tolist()), (k, d)) == (k, d)


def test_repeats_with_a_phrase_in_all_documents(spark):
    import pyarrow as pa

    rnd = random.Random(10)
    texts = []
    for i in range(600):  # one phrase with other words around it, and some documents copied
        around = [f"w{rnd.random()}" for _ in range(10)]
        texts.append(" ".join(around[:5] + "all of these rights are kept by us".split() + around[5:]))
    texts[500:520] = texts[:20]
    rows = table(spark, texts).drop("row").withColumn("row", F.monotonically_increasing_id())
    packed = rows.select(F.col("row"), "doc_id", "text").mapInArrow(repeats._pack, repeats.PACKED)
    hot = repeats._hot_symbols(packed, 300, 1)
    assert 1 <= len(hot) <= 4
    table_ = packed.toArrow().combine_chunks()
    parts = [0] * 64
    for sent in repeats._meeting(64, hot)(iter(table_.to_batches())):
        for bucket, parcel in zip(sent.column("bucket").to_pylist(), sent.column("parcel").to_pylist()):
            if bucket >= 0:
                parts[bucket] += len(repeats._opened([parcel])[0])
    assert sum(parts) >= 580 * 6 and max(parts) <= 3 * sum(parts) / 64
    for settings in ({}, {"bucket_words": 100, "hot": 300, "sample": 1}, {"bucket_words": 100, "hot": 1}):
        got = {r.doc_id: r for r in repeats.remove(rows, **settings).collect()}
        assert len(got) == 600
        for i, text in enumerate(texts):
            copied = 500 <= i < 520
            assert (got[i].n_removed, got[i].kept) == ((18, "") if copied else (0, text))


def test_windows_are_compared_on_all_bits():
    rng = np.random.default_rng(9)
    digest = rng.integers(0, 1 << 64, 64, dtype=np.uint64)
    for bit in range(64):  # a digest and the same one but for a bit, at one symbol
        digest[bit] = digest[0] ^ np.uint64(1 << bit) if bit else digest[0]
    key, row, start = np.full(64, 7, dtype=np.uint64), np.arange(64), np.zeros(64, dtype=np.int64)
    opened = repeats._opened([repeats._parcel(key, row, row, start, digest)])
    assert all((a == b).all() for a, b in zip(opened, (key, row, row, start, digest)))
    assert (repeats._earliest(opened[0], opened[4], opened[2]) == row).all()
    assert (repeats._earliest(digest, key, row) == row).all()
    words = rng.integers(0, 1 << 64, 2000, dtype=np.uint64)
    assert repeats.window_keys(words, np.array([0, 2000]))[2].max() >= 1 << 63


def found_by_rules(text):
    rules = [
        (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        (r"AKIA[A-Z0-9]+", 0, 20),
        (r"[0-9a-f]+", 0, 24),
    ]
    names = ["assign", "access", "hex"]
    return [(names[k], a, b) for a, k, b in sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(rules) for m in re.finditer(p, text or "") if len(m[g]) >= n)]


def test_secrets_scan_unseen_blobs_only(spark, tmp_path):
    texts = [None, "", "é PASSWORD = 'hunter22' x", "token: short", "AKIA" + "A" * 20, "ab" * 12 + " " + "0" * 23, "apikey:abcdef123456 " + "f" * 40]
    docs = table(spark, texts * 3, list(range(21)))
    ledger = str(tmp_path / "ledger")
    got = secrets.scan(docs, ledger, secrets.BASE).collect()
    assert len(got) == 21
    for r in got:
        assert [tuple(s) for s in r.spans] == found_by_rules(r.text)
    assert spark.read.parquet(f"{ledger}/*").count() == 6  # null and empty are one blob
    more = secrets.scan(table(spark, [*texts, "secret=abcdefgh"]), ledger, secrets.BASE)
    assert more.count() == 8 and spark.read.parquet(f"{ledger}/*").count() == 7
    key = "-----BEGIN RSA PRIVATE KEY-----"
    extended = secrets.scan(table(spark, [*texts, key]), ledger)
    assert [r.spans[0].kind for r in extended.collect() if r.text == key] == ["private_key"]
    assert spark.read.parquet(f"{ledger}/*").filter(F.col("rules") == secrets.version(secrets.BASE)).count() == 7
    clean = extended.select(secrets.masked(F.col("text"), F.col("spans")).alias("t"), "text").collect()
    assert all(len(r.t) == len(r.text) and not found_by_rules(r.t) for r in clean if r.text)
    assert secrets.scan(table(spark, []), str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("lengths", [(1e-170, 1e-170), (1e160, 1e160), (1e200, 1e200), (1e-300, 1e100), (1e-170, 1.0)])
def test_neighbours_of_any_finite_length(lengths):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((300, 8)) * np.where(np.arange(300) % 2, *lengths)[:, None]
    block = neighbours.Block(np.arange(300), vectors, 1)
    with np.errstate(over="ignore", invalid="ignore"):
        for query, (ids, found) in zip(range(0, 300, 20), block.nearest(np.arange(0, 300, 20), vectors[::20], 10)):
            assert len(set(ids.tolist())) == 10 and query not in ids
            want = np.einsum("ij,j->i", vectors[ids], vectors[query])
            assert (np.diff(found) <= 0)[np.isfinite(found[1:])].all() and not np.isnan(found).any()
            assert (found == want)[np.isfinite(want)].all()


def test_masking_is_linear(spark):
    import time

    text = "password: hunter2hunter2 é " * 20_000
    spans = [("assign", m.start(), m.end()) for m in re.finditer("hunter2hunter2", text)]
    df = spark.createDataFrame([(text, spans), (None, []), ("ab", []), ("abcdef", [("x", 1, 3), ("y", 2, 5)])], "text string, spans array<struct<kind:string,start:int,end:int>>")
    df.select(secrets.masked(F.col("text"), F.col("spans"))).limit(1).collect()
    start = time.time()
    got = [r[0] for r in df.select(secrets.masked(F.col("text"), F.col("spans"))).collect()]
    assert time.time() - start < 5
    assert got == [text.replace("hunter2hunter2", "*" * 14), None, "ab", "a****f"]


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline

    texts = ["The password: hunter2hunter2 is in the house, and that was not the plan."] * 2 + ["And this is another one of those."]
    docs = table(spark, texts).select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), "n_chars")
    odd = ["row", "__row", "blob", "spans", "score", "lang_pred", "size", "copies", "copy", "taken", "cut", "source_name", "q_h", "a.b"]
    docs = docs.withColumns({c: F.lit(f"own {c}") for c in odd})
    for name, work in corpus_pipeline.STAGES[:-1]:
        made = work(spark, docs, "")
        assert made.columns == docs.columns, name
        rows = made.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in odd), name
        empty = work(spark, docs.limit(0), "")
        assert empty.columns == docs.columns and not empty.collect(), name


def test_jaccard_pairs_are_verified_whatever_texts_are_opened_together(monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcd"), size=n)) for n in (0, 1, 2, 3, 9, 40, 40, 400, 400, 3000)]
    texts += [texts[7] + " a", texts[4].upper(), "word " * 5000]
    packed = [zstandard.ZstdCompressor().compress(t.encode()) for t in texts]
    ends = [(a, b) for b in range(len(texts)) for a in range(b)]

    def words(t):
        w = t.lower().split()
        return {tuple(w[i : i + 3]) for i in range(max(len(w) - 2, min(len(w), 1)))}

    def near(a, b):
        one, other = words(texts[a]), words(texts[b])
        return 100 * len(one & other) >= 60 * len(one | other)

    def batch(pairs):
        a, b = [a for a, _ in pairs], [b for _, b in pairs]
        columns = [a, b, [packed[i] for i in a], [packed[i] for i in b]]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        arrays = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "packed_a", "packed_b"])

    for size in (0, 100, 5000, 1 << 22):
        monkeypatch.setattr(jaccard, "CHUNK_BYTES", size)
        found = jaccard._verified(iter([batch(ends[:30]), batch([]), batch(ends[30:])]), 3, (60, 100))
        linked = [p for f in found for p in zip(f["a"].to_pylist(), f["b"].to_pylist(), strict=True)]
        assert linked == [e for e in ends if near(*e)]


def test_jaccard_sets_that_link_share_one_of_their_first_keys():
    rng = np.random.default_rng(6)
    grades = rng.integers(0, 16, size=1 << jaccard.BUCKETS).astype(np.uint8)
    for link in ((90, 100), (80, 100)):
        for size in (10, 57, 400):
            one = rng.integers(1, 1 << 63, size=size).astype(np.uint64)
            other = one.copy()
            changed = rng.choice(size, size=size // 25, replace=False)
            other[changed] = rng.integers(1, 1 << 63, size=len(changed))
            common = size - len(changed)
            assert link[1] * common >= link[0] * (2 * size - common)
            both = np.append(one, np.append(other, rng.integers(1, 1 << 63, size=3).astype(np.uint64)))
            keys, cut = jaccard._cells(both, np.array([0, size, 2 * size, 2 * size + 3]), link, grades)
            assert set(keys[: cut[1]]) & set(keys[cut[1] : cut[2]])


def test_mixing_keeps_columns_of_any_name(spark):
    plain = mixing.measure(table(spark, corpus()[:40]))
    odd = plain.withColumns({c: F.lit(7) for c in ("cut", "source_name", "name", "rank", "rest", "target", "source_size")})
    columns = ["doc_id", "size", "source_size", "target", "copies", "taken"]
    found = mixing.take(odd, mixing.plan(odd))
    expected = mixing.take(plain, mixing.plan(plain)).select(columns).collect()
    assert sorted(found.select(columns).collect()) == sorted(expected)
    assert {tuple(r) for r in found.select("cut", "source_name", "name", "rank", "rest").collect()} == {(7,) * 5}


def test_repeats_write_no_texts_beside_the_shuffle(spark):
    import os

    from waybill import session

    base = os.path.dirname(session.work_dir(spark, "probe"))
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    texts = [" ".join(f"w{i % 17}" for i in range(40))] * 3 + [None, "short text"]
    docs = table(spark, texts, [3, 1, 2, 4, 5]).drop("row").withColumn("row", F.monotonically_increasing_id())
    got = {r.doc_id: (r.n_words, r.n_removed) for r in repeats.remove(docs).collect()}
    assert got == {1: (40, 0), 2: (40, 40), 3: (40, 40), 4: (0, 0), 5: (2, 0)}
    made = set(os.listdir(base)) - before if os.path.isdir(base) else set()
    assert not [name for name in made if name.startswith("packed-texts")]
