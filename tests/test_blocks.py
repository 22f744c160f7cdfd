"""What large tables cost: blocks, parts and batches of bounded size, with the same results."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civiltext.functions import text as txt
from civiltext.operators import blocks, detection as det, features as ft, lemmas as lm
from civiltext.operators import regression, replacing
from civiltext.operators.lookup import LexiconIndex
from civiltext.sources import shared


def words_of(n, seed=1, letters="abé"):
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=rng.randrange(1, 6))) for _ in range(n)]


def test_block_lists_a_word_once(spark):
    """as many rows as a block has words, not as its texts have."""
    df = spark.createDataFrame([(i, "one two two three") for i in range(500)], "id int, text string")
    texts, n = blocks.with_blocks(df, "text")
    got = blocks.block_words(texts, ["text"], lambda t: set(t.split(" "))).collect()
    assert len(got) == len(set(got)) <= 3 * n and {r.first for r in got} == {"one", "two", "three"}


def test_blocks_stand_behind_their_items(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "id int, text string")
    texts, n = blocks.with_blocks(df, "text")
    items = texts.select(blocks.BLOCK, F.col("id").alias("number"))
    rows = blocks.beside(texts, items, n).withColumn("part", F.spark_partition_id()).collect()
    seen, behind = {}, set()
    for r in rows:
        assert seen.setdefault(r._block, r.part) == r.part
        if r._item is None:
            behind.add(r._block)
        else:
            assert r._block not in behind
    assert sum(r._item is None for r in rows) == 200 and len(rows) == 400


def test_replacing_without_patterns(monkeypatch):
    """Searching folded text finds what case-insensitive patterns find."""
    rng = random.Random(4)
    words = [*words_of(30, 2, "aikſsK"), "İi", "ıx", "ß", "ẞ", "σς", "ΐ", "ᾳ", "ﬅ", "-a", "a-"]
    terms = [" ".join(rng.choices(words, k=rng.randrange(1, 3))) for _ in range(40)]
    own = replacing.Replacer(terms, [" ".join(rng.choices(words, k=2)).upper() for _ in terms])
    texts = [rng.choice(" ,-").join(rng.choices([*words, *(w.upper() for w in words)], k=25))
             for _ in range(300)]
    fast = [own.replace(t, set()) for t in texts]
    monkeypatch.setattr(replacing, "_ODD_CASE", replacing.re.compile(""))
    assert fast == [own.replace(t, set()) for t in texts] and any(log for _, log in fast)


def test_fold_and_patterns_agree_on_plain_letters():
    import _sre
    from re import _casefix
    by_fold, by_pattern = {}, {}
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000 or replacing._ODD_CASE.search(chr(code)):
            continue
        low = _sre.unicode_tolower(code)
        by_fold.setdefault(replacing.fold(chr(code)), set()).add(code)
        by_pattern.setdefault(min(low, *_casefix._EXTRA_CASES.get(low, (low,))), set()).add(code)
    assert set(map(frozenset, by_fold.values())) == set(map(frozenset, by_pattern.values()))


def test_hits_are_handed_on(monkeypatch):
    """the rows of a batch do not grow with the hits of its texts."""
    monkeypatch.setattr(det, "HITS_AT_ONCE", 100)
    texts = ["not so bad fine " * 20] * 50 + [None or ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(51)), pa.array(texts)], names=["id", "_norm"])
    index = LexiconIndex(["bad", "so", "fine"], ["x", "y", "z"], [False] * 3)
    names = ["id", "word", "category", "position", "has_intensifier", "is_negated"]
    made = list(det._hit_rows(iter([batch]), index, names))
    assert len(made) > 20 and max(b.num_rows for b in made) < 160
    rows = [tuple(r.values()) for b in made for r in b.to_pylist()]
    assert len(rows) == 3000
    assert rows[:3] == [(0, "so", "y", 1, False, True), (0, "bad", "x", 2, True, True),
                        (0, "fine", "z", 3, False, True)]


def test_lemmas_of_a_batch_in_pieces(monkeypatch):
    """only a piece of a batch becomes Python strings at a time."""
    from civiltext.operators import termcodes
    monkeypatch.setattr(termcodes, "PIECE_BYTES", 30)
    sizes = []
    monkeypatch.setattr(lm, "pieces", lambda c: (sizes.append(len(p)) or p for p in termcodes.pieces(c)))
    made = []
    monkeypatch.setattr(lm.F, "arrow_udf", lambda f, returnType: made.append(f))
    lm._in_row({"cats": "cat"})
    texts = pa.array(["two cats", None, "", "cats " * 50 + "x"] * 20)
    want = [None if t is None else t.replace("cats", "cat") for t in texts.to_pylist()]
    assert made[0](texts).to_pylist() == want and len(sizes) > 20
    assert made[0](texts.slice(0, 0)).to_pylist() == []


def test_texts_in_even_parts(spark, monkeypatch):
    """F8: no partition grows with the table."""
    df = spark.createDataFrame([(i, "x" * 1000) for i in range(100)], "id int, text string").coalesce(1)
    assert shared.in_parts(df, "text").rdd.getNumPartitions() == 1
    monkeypatch.setattr(shared, "PART_BYTES", 5000)
    dealt = shared.in_parts(df, "text")
    sizes = [len(p) for p in dealt.rdd.glom().collect()]
    assert len(sizes) == 20 and max(sizes) <= 10 and dealt.exceptAll(df).isEmpty()


@pytest.mark.parametrize("octets", [1 << 40, 50])
def test_terms_counted_in_parts(spark, monkeypatch, octets):
    """parts go by the size of the texts, counts stay."""
    monkeypatch.setattr(ft, "PART_BYTES", octets)
    monkeypatch.setattr(ft, "TERM_BYTES", octets)
    texts = [" ".join(words_of(20, i, "ab")) for i in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "tokens string")
    got = {r.term: (r.tf, r.df) for r in ft.term_counts(df, "tokens", (1, 1)).collect()}
    assert got == {w: (sum(t.split().count(w) for t in texts), sum(w in t.split() for t in texts))
                   for t in texts for w in t.split()}
    parts = sum(len(t) for t in texts) // octets
    assert ft.term_counts(df, "tokens").rdd.getNumPartitions() >= min(parts, 9)


def test_blocks_of_regressions_are_bounded(spark, monkeypatch):
    """a block has so many entries, however many texts a batch has."""
    tokens = [(" ".join(f"w{j}" for j in range(i % 7)), i % 2) for i in range(300)]
    df = spark.createDataFrame(tokens, "tokens string, bad int").coalesce(1)
    model = ft.TfidfModel([f"w{j}" for j in range(7)], [1.0] * 7, (1, 1))
    monkeypatch.setattr(regression, "BLOCK_ENTRIES", 50)
    with regression.blocks(df, ["bad"], model) as made:
        rows = made.collect()
        assert len(rows) > 15 and max(len(r.idx) // 4 for r in rows) <= 50
        assert sum(len(r.y) for r in rows) == 300
        value, gradient = regression.value_and_gradient(made, {0: np.zeros(8)}, 300, [150])
    monkeypatch.setattr(regression, "BLOCK_ENTRIES", 1 << 18)
    with regression.blocks(df, ["bad"], model) as made:
        other, same = regression.value_and_gradient(made, {0: np.zeros(8)}, 300, [150])
    assert value == pytest.approx(other) and np.allclose(gradient, same)


def test_steps_kept_save_passes(monkeypatch):
    """the passes over the texts that an uneven objective takes."""
    def passes():
        bends = np.logspace(0, 4, 80)
        found, aim, n = regression._Descent(80), np.linspace(1, 2, 80), 0
        while found.steepest > 0.01:
            moved = found.trial - aim
            found.tell(float(bends @ moved**2 / 2), bends * moved)
            n += 1
        return n

    many = passes()
    monkeypatch.setattr(regression, "MEMORY", 10)
    assert many < 0.7 * passes()


def test_accents_need_no_class_of_all_letters(spark):
    """runs of other letters at both ends, beside lines, alone and of marks only."""
    import unicodedata as u
    texts = ["é", "éa", "aé", "a\né\nb", "ﬁn½ 각é…", "́", "á̂b́", "plain", "", None,
             "日本 ǆ ™ x" * 50, "\né\n\nﬁ\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(txt.strip_accents(F.col("t")).alias("t"))
    want = [None if t is None else "".join(c for ch in t for c in u.normalize("NFKD", ch)
                                           if not u.combining(c)) for t in texts]
    assert [r.t for r in out.collect()] == want
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "RLIKE" in plan and "ﬁ" not in "".join(p[:3000] for p in plan.split("RLIKE [")[1:])


def _blocks_of(spark, monkeypatch, partitions):
    """300 texts in blocks of about ten, as ``regression.blocks`` writes them."""
    monkeypatch.setattr(regression, "BLOCK_ENTRIES", 50)
    tokens = [(" ".join(f"w{j}" for j in range(i % 7)), i % 2) for i in range(300)]
    df = spark.createDataFrame(tokens, "tokens string, bad int").repartition(partitions)
    return regression.blocks(df, ["bad"], ft.TfidfModel([f"w{j}" for j in range(7)], [1.0] * 7, (1, 1)))


def test_tasks_of_a_pass_do_not_grow_with_the_texts(spark, monkeypatch):
    """every task hands on a matrix (labels x terms), so there are as many as the cores ask for."""
    seen, summed = [], regression.summed
    monkeypatch.setattr(regression, "summed", lambda df, *rest: (
        seen.append(df.rdd.getNumPartitions()) or summed(df, *rest)))
    monkeypatch.setattr(regression, "TASKS_A_CORE", 1)
    with _blocks_of(spark, monkeypatch, 60) as made:
        split = made.repartition(60)
        _, gradient = regression.value_and_gradient(split, {0: np.zeros(8)}, 300, [150])
        _, same = regression.value_and_gradient(made, {0: np.zeros(8)}, 300, [150])
        assert split.rdd.getNumPartitions() == 60
    assert seen[0] <= spark.sparkContext.defaultParallelism and np.allclose(gradient, same)


def test_blocks_are_read_in_small_row_groups(spark, monkeypatch):
    """a reader holds a row group whole, so a group has few blocks."""
    import pyarrow.parquet as pq
    monkeypatch.setattr(regression, "FILES", {**regression.FILES, "parquet.block.size": 2000})
    with _blocks_of(spark, monkeypatch, 1) as made:
        groups = [pq.ParquetFile(f.removeprefix("file://")).metadata.num_row_groups
                  for f in made.inputFiles()]
        assert max(groups) > 1 and made.count() > 15


def test_vectors_are_made_a_piece_at_a_time(monkeypatch):
    """entries of a batch come by pieces of its texts, and sums are those of all."""
    from civiltext.operators import termcodes
    texts = pa.array([" ".join(words_of(30, i, "ab")) if i % 5 else "" for i in range(60)])
    made = ft.Vectorizer(sorted({w for t in texts.to_pylist() for w in t.split()}),
                         [1.5] * len({w for t in texts.to_pylist() for w in t.split()}), (1, 1))
    whole, weights = made.entries(texts), np.arange(2.0 * len(made.codes)).reshape(2, -1)
    sums = made.sums(texts, weights)
    monkeypatch.setattr(termcodes, "PIECE_BYTES", 300)
    parts = list(made.by_piece(texts))
    assert len(parts) > 10 and [p[0].start for p in parts[1:]] == [p[0].stop for p in parts[:-1]]
    assert all((a == b).all() for a, b in zip(whole, made.entries(texts)))
    assert np.allclose(sums, made.sums(texts, weights)) and sums.shape == (60, 2)
    assert made.sums(texts.slice(0, 0), weights).shape == (0, 2)


def test_steps_kept_take_half(monkeypatch):
    """the driver keeps single-precision steps; the minimum is found all the same."""
    bends = np.logspace(0, 2, 50)
    found, aim = regression._Descent(50), np.linspace(1, 2, 50)
    while found.steepest > 0.001:
        moved = found.trial - aim
        found.tell(float(bends @ moved**2 / 2), bends * moved)
    assert np.allclose(found.point, aim, atol=0.01) and found.point.dtype == np.float64
    assert {v.dtype for pair in found.pairs for v in pair[:2]} == {np.dtype(np.float32)}


def test_counts_of_pieces_are_added_up_before_they_are_handed_on(spark, monkeypatch):
    """a term of many pieces leaves the task once, and counts stay."""
    from civiltext.operators import termcodes
    monkeypatch.setattr(termcodes, "PIECE_BYTES", 100)
    parts = [pa.RecordBatch.from_pydict({"term": ["a", "b"], "tf": [i, 1], "df": [1, 1]}) for i in range(9)]
    rows = [r for b in ft._added_up(parts) for r in b.to_pylist()]
    assert sorted(rows, key=lambda r: r["term"]) == [{"term": "a", "tf": 36, "df": 9},
                                                     {"term": "b", "tf": 9, "df": 9}]
    assert list(ft._added_up([])) == []


def test_batches_are_looked_up_in_slices(monkeypatch):
    """an array per batch, though no more than so many rows become objects at once."""
    monkeypatch.setattr(blocks, "ROWS", 3)
    items = [None if i % 5 else {"n": i // 5} for i in range(20)]
    numbers, values = pa.array([i // 5 for i in range(20)], pa.int32()), pa.array(range(20))
    batches = [[c.slice(a, b - a) for c in (numbers, pa.array(items), values)] for a, b in
               [(0, 7), (7, 7), (7, 20)]]
    sizes = []
    made = list(blocks.looked_up_arrays(
        iter(batches), lambda own: lambda v: own[0]["n"] * 100 + v,
        lambda done: sizes.append(len(done)) or pa.array(done, pa.int64())))
    assert [len(a) for a in made] == [7, 0, 13] and max(sizes) == 3
    assert [v for a in made for v in a.to_pylist()] == [
        None if i % 5 == 0 else i // 5 * 100 + i for i in range(20)]


def test_marks_kept_for_tokens(monkeypatch):
    """a token is marked as before, whether it came up before or not and whatever the terms."""
    from civiltext.operators import lookup
    monkeypatch.setattr(lookup, "MAX_KEPT", 3)
    rng = random.Random(4)
    marker, parts = lookup.Marker(3), ["ab", "(", "c+", "é", ".", " ", "\n", "<", "x_", "İ", "ſ", "ͅ", "\x85"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randrange(12)))
        terms = frozenset(lookup.fold(t) for t in rng.sample(["ab", "AB(", "c+", "x_", "é", "s", "i", "x_ab"], 4))
        tokens = set(lookup._TOKEN.findall(text))
        assert sorted(marker.all_candidates(text)) == sorted(
            {lookup.fold(t[a:b]) for t in tokens for a, b in marker.candidates(t)})
        want, done = [], 0
        for match in lookup._TOKEN.finditer(text):
            token, at = match.group(), match.start()
            for a, b in marker.candidates(token):
                if lookup.fold(token[a:b]) in terms:
                    want += [lookup.escape_html(text[done:at + a]), lookup.tables.MARK_OPEN,
                             lookup.escape_html(token[a:b]), lookup.tables.MARK_CLOSE]
                    done = at + b
                    break
        assert marker.mark(text, terms) == "".join([*want, lookup.escape_html(text[done:])])


def test_long_words_clean_a_text_once(spark, tmp_path):
    """the listing of the words; a plain explode has its filter clean each text twice more."""
    from civiltext.plans import catalog
    spark.createDataFrame([(1, "Incomprehensible, short extraordinary"), (2, None), (3, " ")],
                          "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.long_words(spark, str(tmp_path))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 2
    assert {r.term for r in out.collect()} == {"incomprehensible", "extraordinary"}


def test_training_caches_nothing(spark, monkeypatch):
    """F7, F8, F9, F2: no vectors of the texts stay in the executors' heaps, for one label or several."""
    from civiltext.operators import classifier as clf
    kept = []
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda df, *_: kept.append(df) or df)
    df = spark.createDataFrame([(str(i), f"good text {'bad' if i % 2 else 'fine'} word{i % 3}", i % 2, i % 3 // 2)
                                for i in range(60)], "id string, comment_text string, toxic int, threat int")
    for labels in (["toxic"], ["toxic", "threat"]):
        model, _ = clf.train(df, labels=labels)
        assert max(r["gradient"] for r in model.training) < 0.02 and not kept
        assert model.feature_importance(spark, "toxic", 1).first().word in ("bad", "bad word0", "text bad")
