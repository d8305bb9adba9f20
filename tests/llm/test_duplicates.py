"""SimHash links, sentence spans and sketches against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from marketlake.llm import graph, sentence_dedup, simhash, sketch


def words(rnd, n, vocabulary=400):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


# --- SimHash ---------------------------------------------------------------------

def plain_fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    ones = Counter(i for g in grams for i in range(64) if xxhash.xxh64_intdigest(g, 42) >> i & 1)
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(grams))


def plain_components(rows, bits):
    fp = {i: f for i, f in enumerate(f for _, f in rows)}
    group = {i: i for i in fp}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in fp:
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= bits:
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, f"{f:016x}", least.get(root(i))) for i, (d, f) in enumerate(rows)), key=str)


@pytest.fixture(scope="module")
def near(spark):
    rnd = random.Random(2)
    rows = [(1000 + i, t) for i, t in enumerate([None, "", "A b", "a  B", "x" * 9000, "É é z\x1fq"])]
    for i in range(25):
        base = words(rnd, rnd.randrange(3, 300))
        for k in range(rnd.randrange(1, 8)):
            edit = list(base)
            if k:
                edit[rnd.randrange(len(edit))] = "edited"
            rows.append((len(rows) * 7 % 997, " ".join(edit)))
    rows += [rows[10], (None, rows[11][1]), (None, "nobody's own text here"), (5, "w1 w2 w3")]
    return rows


@pytest.mark.parametrize("bits,small", [(2, 64), (2, 1), (1, 1), (3, 64)])
def test_components_equal_brute_force(spark, near, bits, small):
    df = spark.createDataFrame([(*r, "z", 0) for r in near], "doc_id bigint, text string, fp string, component_id int")
    got = simhash.near_duplicates(df.repartition(4), max_bits=bits, small_bucket=small).collect()
    want = plain_components([(d, plain_fingerprint(t)) for d, t in near], bits)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want


def test_every_near_pair_meets_in_a_table():
    rnd = random.Random(4)
    for radius in (1, 2, 3):
        tables = simhash.masks(radius)
        assert len(tables) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            diff = sum(1 << i for i in rnd.sample(range(64), radius))
            assert any(diff & m == 0 for m in tables)


def test_a_large_bucket_is_linked_whole(spark):
    """A chain of fingerprints two bits apart, in buckets far above the limit for direct comparison."""
    values = [sum(1 << b for b in range(2 * i)) for i in range(30)]
    rnd = random.Random(1)
    values += [values[9] ^ (1 << rnd.randrange(20, 64)) for _ in range(40)]
    df = spark.createDataFrame([(simhash._signed(v),) for v in set(values)], "fp bigint")
    for small in (1, 64):
        found = graph.components(simhash.links(df, 2, small)).collect()
        assert len({r.root for r in found}) == 1 and len(found) == len(set(values))


def test_keep_one(spark, near):
    df = spark.createDataFrame([(d, t, "x") for d, t in near], "doc_id bigint, text string, kept_id string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    rows = plain_components([(d, plain_fingerprint(t)) for d, t in near], 2)
    want = sorted({d for d, _, c in rows if d is not None and d == c})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert kept.where("doc_id is null").count() == 2


def test_an_id_with_texts_in_two_groups_keeps_both_places(spark):
    rnd = random.Random(12)
    a, b, c = (" ".join(words(rnd, 60, 10 ** 6)) for _ in range(3))
    rows = [(1, a), (5, a), (5, b), (9, b), (5, c), (5, c), (7, None), (7, "")]
    df = spark.createDataFrame([(*r, i % 2) for i, r in enumerate(rows)], "doc_id bigint, text string, row int").repartition(4)
    got = sorted((r.doc_id, r.text or "") for r in simhash.keep_one(df).collect())
    # a goes with id 1; b and c are found under id 5 alone, each with one row
    assert got == sorted([(1, a), (5, b), (5, c), (7, "")])
    empty = df.limit(0)
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 7), (9, 3), (3, 9), (9, 3), (5, 160)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 5), 5: 5, 3: 3, 9: 3}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- sentence spans ----------------------------------------------------------------

def plain_dedup(rows, run, least):
    """(id, text) -> removed sentences, rows in (id, row hash) order."""
    import pyspark.sql.functions  # noqa: F401 - the order of equal ids needs Spark's hash; ids are distinct here

    first, out = {}, {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        cut, piece = sentence_dedup._units(t or "")
        keys = [" ".join((t or "")[a:b].lower().split()) for a, b in cut]
        n_words = [len(k.split()) for k in keys]
        gone = set()
        for i in range(max(len(keys) - run, 0) + 1 if keys else 0):
            end = min(i + run, len(keys))
            while any(piece[i:i + run]) and sum(n_words[i:end]) < sentence_dedup.PIECE_WORDS and end < len(keys):
                end += 1
            span = tuple(keys[i:end])
            if sum(n_words[i:end]) < least:
                continue
            if span in first and first[span] != (d, i):
                gone.update(range(i, end))
            first.setdefault(span, (d, i))
        out[d] = (len(keys), sorted(gone))
    return out


def test_sentence_dedup_equals_brute_force(spark):
    rnd = random.Random(8)
    stock = [" ".join(words(rnd, rnd.randrange(1, 12))).capitalize() + rnd.choice([".", "!", "?", ".”"]) for _ in range(60)]
    passage = stock[:7]
    rows = [(None, None), (1, ""), (2, "No end"), (3, "One. Two. Three.")]
    for d in range(10, 60):
        parts = [rnd.choice(stock) for _ in range(rnd.randrange(0, 12))]
        if d % 3 == 0:
            parts[2:2] = passage
        rows.append((d, rnd.choice([" ", "\n", "  "]).join(parts)))
    df = spark.createDataFrame([(*r, 1, [2]) for r in rows], "doc_id bigint, text string, starts int, row array<int>")
    out = sentence_dedup.dedup_sentences(df.repartition(6), prefix="s_")
    assert out.columns == [*df.columns, "s_n_sentences", "s_n_removed", "s_removed"]
    want, texts = plain_dedup(rows, 3, 10), dict(rows)
    for r in out.collect():
        n, gone = want[r.doc_id]
        assert (r.s_n_sentences, r.s_n_removed) == (n, len(gone))
        assert [i for a, k in r.s_removed for i in range(a, a + k)] == gone
        if not gone:
            assert r.text == texts[r.doc_id]
        else:
            cut = sentence_dedup.sentences(texts[r.doc_id])
            left = "".join(texts[r.doc_id][a:b] for i, (a, b) in enumerate(cut) if i not in gone).rstrip()
            assert r.text == left
    holders = [d for d, t in rows if d and d >= 10 and d % 3 == 0]
    whole = " ".join(x.lower() for x in passage)
    left = {r.doc_id: " ".join((r.text or "").lower().split()) for r in out.collect()}
    assert [d for d in holders if whole in left[d]] == holders[:1]


def test_repeated_rows_and_ids_are_one_document(spark):
    t = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen."
    df = spark.createDataFrame([(4, t), (4, t), (4, t + " More of it here."), (9, t), (None, t)], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in sentence_dedup.dedup_sentences(df).collect()), key=str)
    # one of the two texts of id 4 is first; later ids and the null id lose the span
    assert got in ([(4, 0), (4, 0), (4, 3), (9, 3), (None, 3)], [(4, 0), (4, 3), (4, 3), (9, 3), (None, 3)])
    assert sentence_dedup.dedup_sentences(df.limit(0)).count() == 0


def test_short_spans_are_deduplicated(spark):
    t = "Ja. Nein. Doch."
    df = spark.createDataFrame([(1, t), (2, f"Own words here. {t} More."), (3, "一 二。\n三。\n四。"), (4, "一 二。\n三。\n四。")],
                               "doc_id bigint, text string")
    got = {r.doc_id: r.removed for r in sentence_dedup.dedup_sentences(df).collect()}
    assert got == {1: [], 2: [[1, 3]], 3: [], 4: [[0, 3]]}


def test_texts_of_few_sentences_are_deduplicated(spark):
    rnd = random.Random(5)
    passage, cjk = words(rnd, 50, 10 ** 6), "".join(chr(0x4e00 + rnd.randrange(5000)) for _ in range(50))
    rows = [(1, "Just one sentence."), (2, "just  one sentence."), (3, "Two. Sentences."), (4, "Two. Sentences."),
            (5, " ".join(words(rnd, 30, 10 ** 6) + passage + words(rnd, 40, 10 ** 6))),
            (6, " ".join(words(rnd, 57, 10 ** 6) + passage + words(rnd, 9, 10 ** 6))),
            (7, "甲乙。丙丁！」戊己？庚"), (8, "子丑。甲乙。丙丁！」戊己？"),
            (9, cjk + "天地玄黃" * 3), (10, "宇宙洪荒" * 2 + cjk)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in sentence_dedup.dedup_sentences(df.repartition(3)).collect()}
    assert [got[d].n_removed for d in (1, 2, 3, 4, 5, 7, 9)] == [0, 1, 0, 2, 0, 0, 0]
    assert got[8].removed == [[1, 3]] and got[8].text == "子丑。"
    # long sentences: what both hold goes but for its edges, what stands around it stays
    own = rows[5][1].split()
    left = got[6].text.split()
    assert len(set(left) & set(passage)) <= 4 * sentence_dedup.WINDOW
    assert set(own) - set(passage) <= set(left) and 0 < got[6].n_removed < got[6].n_sentences
    assert len(got[10].text) < len(rows[9][1]) - 10 and got[10].text.startswith("宇宙洪荒")


def test_any_50_equal_words_of_long_sentences_hold_a_span():
    for seed in range(300):
        rnd = random.Random(seed)
        vocabulary = rnd.choice([2, 30, 10 ** 6])
        passage = words(rnd, 50, vocabulary)
        found = []
        for _ in range(2):
            text = " ".join(words(rnd, rnd.randrange(60), vocabulary) + ["w"] + passage + ["w"] + words(rnd, rnd.randrange(60), vocabulary))
            assert len(text.split()) > sentence_dedup.LONG
            found.append({s for _, s in sentence_dedup.spans(text, 3, 0)[1]})
        assert found[0] & found[1]


def test_passages_of_mid_sized_sentences_are_caught(spark):
    """51 shared words, cut by whole sentences or not, in texts whose sentences have up to 50 words."""
    caught = 0
    for seed in range(100):
        rnd = random.Random(seed)
        passage = words(rnd, 51, 10 ** 6)
        for i in range(rnd.randrange(4, 30), 51, rnd.randrange(26, 50)):
            passage[i] += "."
        found = [{h for _, h in sentence_dedup.spans(" ".join(
            words(rnd, rnd.randrange(5, 40), 10 ** 6) + passage + words(rnd, rnd.randrange(5, 40), 10 ** 6)) + ".", 3, 0)[1]}
            for _ in range(2)]
        caught += bool(found[0] & found[1])
    assert caught >= 90


def test_columns_called_like_the_result(spark):
    t = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen."
    df = spark.createDataFrame([(1, t, 7, "a"), (2, t, 8, "b")], "doc_id bigint, text string, n_removed int, removed string")
    out = sentence_dedup.dedup_sentences(df)
    assert out.columns == [*df.columns, *sentence_dedup.result_names(df)] == [*df.columns, "n_sentences", "_n_removed", "_removed"]
    assert sorted((r.doc_id, r.n_removed, r._n_removed) for r in out.collect()) == [(1, 7, 0), (2, 8, 3)]


# --- sketches -------------------------------------------------------------------------

def test_compare_next_equals_brute_force(spark):
    rnd = random.Random(6)
    rows = [(i * 3 % 101, " ".join(words(rnd, rnd.randrange(0, 90)))) for i in range(100)]
    rows += [(None, None), (500, ""), (501, "é" * 3000), (502, None), (503, "a b c d e f g")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, block string").repartition(7)
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for size in (300, 1 << 30):
        got = {r.doc_id: r for r in sketch.compare_next(df, block_bytes=size).collect()}
        assert len(got) == len(rows)
        for i, (d, t) in enumerate(order):
            following = order[(i + 1) % len(order)][1]
            n = len(t) // 4
            changed = t[:len(t) - n] + following[:n]
            r = got[d]
            own, other, after = (sketch.sketch(x) for x in (t, changed, following))
            assert r.n_chars == len(t)
            assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
            assert (r.fingerprint, r.edited_fingerprint) == (sketch.text_of(own), sketch.text_of(other))
            assert r.near_edited == sketch.likeness(own, other) and r.near_next == sketch.likeness(own, after)
            assert (sketch.sketch_of(r.fingerprint) == own).all()


def test_ties_repeated_rows_and_one_row(spark):
    df = spark.createDataFrame([(1, "b b b b b b"), (1, "a a a a a a"), (1, "a a a a a a"), (2, "c")], "doc_id bigint, text string")
    got = sorted((r.n_chars, r.edited_sha256) for r in sketch.compare_next(df).collect())
    want = [("a a a a a a", "a a a a a a"), ("a a a a a a", "b b b b b b"), ("b b b b b b", "c"), ("c", "a a a a a a")]
    assert got == sorted((len(t), hashlib.sha256(sketch.edited(t, n).encode()).hexdigest()) for t, n in want)
    one = sketch.compare_next(df.where("doc_id = 2")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert sketch.compare_next(df.limit(0)).count() == 0


def test_sketches_merge_and_estimate_containment():
    rnd = random.Random(3)
    small, large = words(rnd, 2000, 10 ** 6), words(rnd, 20000, 10 ** 6)
    a, b = sketch.sketch(" ".join(small)), sketch.sketch(" ".join(large + small))
    assert abs(sketch.containment(a, b) - 1) < 0.05 and sketch.containment(b, a) < 0.2
    both = sketch.sketch(" ".join(large + ["|"] + small))
    merged = sketch.merge(a, sketch.sketch(" ".join(large)))
    assert len(np.setxor1d(both, merged)) <= 8
    assert abs(len(a) / 1996 - sketch.FRACTION) < 0.03


def test_short_texts_have_a_sketch():
    """Unlike short texts are not alike, and estimates hold on average however short the texts are."""
    rnd = random.Random(12)
    texts = [" ".join(words(rnd, rnd.randrange(1, 13), 10 ** 6)) for _ in range(600)]
    found = [sketch.sketch(t) for t in texts]
    assert all(len(s) for s in found) and not len(sketch.sketch(" \n"))
    assert max(sketch.likeness(a, b) for a, b in zip(found, found[1:])) == 0
    empty = sketch.sketch("")
    assert sketch.likeness(empty, empty) == 1 and sketch.likeness(empty, found[0]) == sketch.containment(found[0], empty) == 0
    for a, b in zip(texts, texts[1:]):
        both = np.union1d(sketch.sketch(a, fraction=1.0), sketch.sketch(b, fraction=1.0))
        low = both[both < int(sketch.FRACTION * 2 ** 48)]
        assert (sketch.merge(sketch.sketch(a), sketch.sketch(b)) == (low if len(low) else both[:1])).all()
