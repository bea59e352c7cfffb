"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names for every operator."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratinglens.llm import (
    decontaminate,
    language,
    licenses,
    lines,
    packing,
    quality,
    sampling,
    simhash,
    substrings,
    token_files,
    toxicity,
)
from ratinglens.llm.components import _large_star, components
from ratinglens.llm.tokens import PieceEncoder, tokenizer_file
from ratinglens.session import staged

LONG = " ".join(f"word{i % 977} of{i}" for i in range(60_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, key int, n int, score string, _row int, h int"
BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")


def odd_rows():
    base = [
        (1, None, "en"),
        (2, "", None),
        (3, LONG, "en"),
        (4, "plain words and the rest of it", "en"),
        (4, "plain words and the rest of it", "en"),
        (5, "plain words and the rest of it", "fr"),
        (None, "plain words and the rest of it", None),
        (None, None, None),
        (6, " \n\t ", "en"),
        (7, "$$$ 123 !!!", "en"),
    ]
    return [(i, t, lang, None, None, "x", 1, 2, "y", 3, 4) for i, t, lang in base]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "plain words"), (1, "plain words"), (None, "and the"), (2, None), (3, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_near_duplicates(odd, none):
    got = simhash.near_duplicates(odd).toPandas()
    assert len(got) == 10
    assert set(got[got.doc_id.isin([4, 5])].component_id) == {4}
    # texts without words have fingerprint zero and link
    assert got[got.doc_id.isin([1, 2, 6])].fp.tolist() == [0, 0, 0]
    assert set(got[got.doc_id.isin([1, 2, 6])].component_id) == {1}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 7]
    assert simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 3, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    tables = simhash.masks(radius)
    assert len(tables) == 2 ** (radius + 1) - 1
    rng = np.random.default_rng(radius)
    for _ in range(3000):
        bits = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
        assert any(bits & m == 0 for m in tables)


def test_links_of_a_dense_group(spark, monkeypatch):
    """Near copies around several centres: the components are those of all pairs."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(3)
    prints = set()
    for center in rng.integers(0, 2**63, 4).tolist():
        for _ in range(60):
            flips = rng.choice(32, 5, replace=False)
            prints.add(center ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    want = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 4 and want[b] < want[a]:
                    want[a], changed = want[b], True
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r["node"]: r["component"] for r in components(simhash.links(table, 4)).collect()}
    assert {p: found.get(p, p) for p in prints} == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(50, 40), (40, 50), (60, 60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 40: 40, 50: 40}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing(odd, none):
    got = packing.pack(odd, WORDS, 1, 64).toPandas()
    assert len(got[got.doc_id == 4]) == 2 and len(got[got.doc_id.isna()]) == 2
    assert got[got.doc_id == 1].length.tolist() == [1]
    assert got.groupby("sequence_id").length.sum().max() <= 64
    assert packing.pack(none, WORDS, 1).count() == 0


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(5)
    for _ in range(200):
        capacity = int(rng.integers(4, 60))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 150))).tolist()
        counts = {n: lengths.count(n) for n in set(lengths)}
        rooms: list[int] = []
        for n in sorted(lengths, reverse=True):
            fitting = [k for k, room in enumerate(rooms) if room >= n]
            if fitting:
                rooms[min(fitting, key=lambda k: rooms[k])] -= n
            else:
                rooms.append(capacity - n)
        rows = packing.plan(counts.items(), capacity)
        filled: dict[int, list[tuple[int, int]]] = {}
        for n, count in counts.items():
            own = sorted(r for r in rows if r[0] == n)
            for rank in range(count):
                _, first, sequence, offset, per = [r for r in own if r[1] <= rank][-1]
                filled.setdefault(sequence + (rank - first) // per, []).append((offset + (rank - first) % per * n, n))
        for places in filled.values():
            at = 0
            for offset, n in sorted(places):
                assert offset == at
                at += n
        assert sorted(capacity - sum(n for _, n in p) for p in filled.values()) == sorted(rooms)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_the_whole_text(path):
    coder = PieceEncoder(path)
    rng = np.random.default_rng(2)
    signs = list("ab Z9 é \n\t  ,.'’$<|>— 中ß  ́\x0b\x1c😀") + ["<|endoftext|>", "'s", " the"]
    for _ in range(1500):
        text = "".join(rng.choice(signs, int(rng.integers(0, 40))))
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode([text])[0], dtype="<u4").tolist() == want, repr(text)


def test_token_files(spark, odd, none):
    manifest = token_files.write_shards(odd, BYTES, 0)
    got = token_files.read_documents(manifest).toPandas()
    assert len(got) == 10 and sorted(got.start)[0] == 0
    order = got.sort_values(["start"])
    assert order.start.tolist() == [0, *order.n_tokens.cumsum().tolist()[:-1]]
    keys = order.doc_id.fillna(-1).tolist()
    assert keys == sorted(keys)
    assert [len(ids) for ids in token_files.fetch(spark, manifest, 4)] == got[got.doc_id == 4].n_tokens.tolist()
    assert token_files.fetch(spark, manifest, 99) == []
    assert token_files.read_documents(token_files.write_shards(none, BYTES, 0)).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(1).choice(2**62, 20_000, replace=False).astype(np.uint64)
    index = token_files.PerfectHash.build(keys)
    assert sorted(index.places(keys).tolist()) == list(range(len(keys)))
    assert token_files.PerfectHash.build(keys[:0]).places(keys[:3]).tolist() == [-1] * 3


@pytest.mark.parametrize(
    ("expression", "names", "permissive"),
    [
        ("MIT", {"mit"}, True),
        ("MIT OR GPL-2.0-only", {"mit", "gpl-2.0-only"}, True),
        ("MIT AND (GPL-2.0-only OR Apache-2.0)", {"mit", "gpl-2.0-only", "apache-2.0"}, True),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT", {"gpl-2.0-only", "mit"}, False),
    ],
)
def test_license_expressions(expression, names, permissive):
    assert licenses.read_expression(expression) == (names, permissive)


@pytest.mark.parametrize("expression", ["", "MIT AND", "(MIT", "MIT)", "MIT Apache-2.0", "OR MIT"])
def test_malformed_license_expressions(expression):
    assert licenses.read_expression(expression) is None


def test_licenses(odd, none):
    got = licenses.scan_licenses(odd)
    assert got.count() == 10 and "fp" in got.columns
    assert licenses.scan_licenses(none).count() == 0
    n, base, first, last, names, labels, permissive, _ = licenses.scan(
        "// SPDX-License-Identifier: (MIT OR Apache-2.0)\nMIT-License; mit license\nAll rights reserved"
    )
    assert (base, first, last, names, permissive) == (2, 8, 10, "mit", True)
    assert labels == "all-rights-reserved,apache-2.0,mit"


def test_substrings(odd, none, spark):
    got = substrings.remove_repeats(odd, window=3).toPandas()
    assert len(got) == 10
    assert (got[got.doc_id.isin([4, 5])].kept == "").all()
    assert substrings.remove_repeats(none).count() == 0
    short = spark.createDataFrame([(1, "a b c x y a b c"), (2, "b c d"), (3, "q b c d q")], "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in substrings.remove_repeats(short, window=3).collect()}
    assert kept == {1: "x y", 2: "", 3: "q q"}


@pytest.mark.parametrize("window", [1, 2, 5, 8, 40])
def test_substrings_of_many_widths(spark, window):
    rng = np.random.default_rng(window)
    rows = [(i, " ".join(rng.choice(list("abc"), int(rng.integers(0, 120))))) for i in range(30)]
    words = {i: t.split() for i, t in rows}
    seen: dict[tuple, int] = {}
    for own in words.values():
        for k in range(len(own) - window + 1):
            seen[tuple(own[k : k + window])] = seen.get(tuple(own[k : k + window]), 0) + 1
    got = {r["doc_id"]: r["kept"] for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=window).collect()}
    for i, own in words.items():
        gone = {j for k in range(len(own) - window + 1) if seen[tuple(own[k : k + window])] > 1 for j in range(k, k + window)}
        assert got[i] == " ".join(w for k, w in enumerate(own) if k not in gone)


@pytest.mark.parametrize("period", [1, 2, 7, 13, 21])
def test_difference_cover(period):
    cover = substrings.difference_cover(period)
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def test_lines(odd, none, spark):
    got = lines.drop_shared_lines(odd)
    assert got.columns[:-2] == odd.columns and got.count() == 10
    assert lines.drop_shared_lines(none).count() == 0
    rows = [(i, f"own {i}\n shared \nlast", f"s{i % 6}") for i in range(12)] + [(12, None, "s1"), (13, "shared", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in lines.drop_shared_lines(table, min_sites=5).collect()}
    assert kept[0] == "own 0\n shared \nlast" and kept[7] == "own 7" and kept[12] is None and kept[13] == ""


def test_toxicity(odd, none, spark):
    labels = spark.createDataFrame([(4, 1), (3, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    got = toxicity.score_toxicity(odd, model).toPandas()
    assert len(got) == 10 and got.score.between(0, 1).all()
    assert toxicity.train(none, labels) is None
    assert set(toxicity.score_toxicity(odd, None).toPandas().score) == {0.0}
    assert toxicity.score_toxicity(none, model).count() == 0


def test_toxicity_measures_density():
    # all rows hold the word that marks toxic text; only its share of the text tells them apart
    rows = []
    for k in range(60):
        plain = [f"word{(k * 7 + j) % 40}" for j in range(200)]
        rows += [(" ".join([*plain, *["zzachlich"] * 12]), "1"), (" ".join([*plain * 4, "zzachlich"]), "0")]
    score = toxicity.fit(rows).scorer()
    plain = " ".join(f"word{j % 40}" for j in range(400))
    assert score(plain + " zzachlich" * 24) >= 0.5 > score(plain * 2 + " zzachlich")
    assert score(plain * 20 + " zzachlich") < 0.5 and score("") < 0.5 and score(None) < 0.5


def test_classifiers_learn_from_whole_texts(spark):
    filler = " ".join(f"{k:04d}" for k in range(2_000))  # 10,000 characters without a letter
    rows = []
    for k in range(40):
        plain = " ".join(f"word{(k * 7 + j) % 40}" for j in range(40))
        rows.append((k, f"{filler} {plain}" + " zzachlich" * (9 if k % 2 else 0), k % 2, "de" if k % 2 else "fr"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, lang string")
    model = toxicity.train(docs, docs)
    got = toxicity.score_toxicity(docs, model).toPandas()
    assert (got.predicted == got.toxic).all()
    known = sampling.labelled_sample(docs, docs, "toxic", 100).orderBy("place", "label").collect()
    plain_model = toxicity.fit([(r["text"], r["label"]) for r in known])
    assert (model.toxic, model.ordinary, model.weights) == (plain_model.toxic, plain_model.ordinary, plain_model.weights)
    assert model.threshold == pytest.approx(plain_model.threshold)
    assert set(language.train(docs, docs).languages["germanic"]) == {"de"}  # no letter in the first 8,000 characters


def test_sample_ranks_few_rows_of_a_frequent_label(spark):
    ids = spark.range(3_000).selectExpr("id doc_id", "cast(id as string) text", "0 toxic")
    sample = sampling.labelled_sample(ids, ids, "toxic", {"1": 5, "0": 7})
    ranked = sample._jdf.queryExecution().optimizedPlan().toString()
    bound = -(1 << 63) + int(8 * 7 / 3_000 * (1 << 64))
    assert f"<= {bound}" in ranked
    want = ids.selectExpr("text", "xxhash64(doc_id) h").orderBy("h").limit(7).collect()
    assert [(r["place"], r["text"]) for r in sample.orderBy("place").collect()] == [(k + 1, r["text"]) for k, r in enumerate(want)]


def test_decontamination(odd, none, benchmark, spark):
    got = decontaminate.find_leaks(odd, benchmark).toPandas()
    assert got[got.doc_id == 4].n_hit.tolist() == [4, 4]
    assert got[got.doc_id == 4].item_ids.tolist() == ["1", "1"]
    assert decontaminate.find_leaks(none, benchmark).count() == 0
    assert decontaminate.find_leaks(odd, spark.createDataFrame([], "item_id long, text string")).toPandas().n_hit.sum() == 0
    clean = decontaminate.remove_leaks(odd, benchmark)
    assert clean.columns == odd.columns
    assert [r["text"].split() for r in clean.where("doc_id = 5").collect()] == [["rest", "of", "it"]]


def test_fm_index_finds_every_place():
    rng = np.random.default_rng(4)
    for _ in range(60):
        text = rng.integers(0, 4, int(rng.integers(1, 200)))
        index = decontaminate.FmIndex(text, 3)
        for width in (1, 2, 5):
            patterns = np.unique(rng.integers(1, 4, (8, width)), axis=0)
            got = sorted(zip(*(a.tolist() for a in index.search(patterns)), strict=True))
            want = [(k, i) for k, p in enumerate(patterns) for i in range(len(text) - width + 1) if (text[i : i + width] == p).all()]
            assert got == sorted(want)


def test_benchmark_in_blocks(odd, benchmark, monkeypatch):
    whole = decontaminate.find_leaks(odd, benchmark).toPandas()
    columns, order = ["doc_id", "n_words", "n_hit", "n_items", "item_ids"], ["doc_id", "n_words"]
    cut = decontaminate.remove_leaks(odd, benchmark).toPandas().sort_values(["doc_id", "text"], ignore_index=True)
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 1)
    blocks = decontaminate.find_leaks(odd, benchmark)
    assert blocks.columns == decontaminate.find_leaks(odd, benchmark).columns
    got = blocks.toPandas()[columns].sort_values(order, ignore_index=True)
    assert got.equals(whole[columns].sort_values(order, ignore_index=True))
    again = decontaminate.remove_leaks(odd, benchmark)
    assert again.columns == odd.columns
    assert again.toPandas().sort_values(["doc_id", "text"], ignore_index=True).equals(cut)


def test_quality(odd, none):
    got = quality.judge(odd).toPandas()
    assert got[got.doc_id.isin([1, 2, 6])].n_words.tolist() == [0, 0, 0]
    assert not got[got.doc_id != 3].kept.any()
    assert got[got.doc_id == 3].n_words.tolist() == [120_000]
    assert quality.judge(none).count() == 0


def test_language(odd, none, spark):
    model = language.train(odd, odd.select("doc_id", "lang"))
    got = language.identify(odd, model).toPandas()
    assert set(got[got.doc_id.isin([1, 2, 6, 7])].lang_pred) == {"und"}
    assert set(got.lang_pred) <= {"und", "en", "fr"}
    empty = language.train(none, none.select("doc_id", "lang"))
    assert set(language.identify(odd, empty).toPandas().lang_pred) == {"und"}
    one = language.fit([("some words here", "en")])
    assert one.predict("other words") == ("en", 1.0)
    assert language.identify(none, model).count() == 0


def test_grams_across_blocks(monkeypatch):
    text = "Über den Wolken, muß die Freiheit wohl 123 grenzenlos sein... " * 9
    whole = language.grams(text)
    for block in (1, 2, 3, 7, 50):
        monkeypatch.setattr(language, "_BLOCK", block)
        assert np.array_equal(language.grams(text), whole)


@pytest.mark.parametrize(
    ("rest", "names", "permissive"),
    [
        ("MIT Copyright 2020 X", {"mit"}, True),
        ("MIT.", {"mit"}, True),
        ("Apache-2.0 OR (MIT", {"apache-2.0"}, True),
        ("(MIT OR GPL-2.0-only) more words", {"mit", "gpl-2.0-only"}, True),
        ("GPL-2.0+, see below", {"gpl-2.0+"}, False),
        ("GPL-2.0-only WITH Classpath-exception-2.0 AND", {"gpl-2.0-only"}, False),
    ],
)
def test_license_tags_end_before_other_text(rest, names, permissive):
    assert licenses.read_tag(rest) == (names, permissive)
    assert names <= set(licenses.scan(f"x\n# SPDX-License-Identifier: {rest}\ny")[5].split(","))


@pytest.mark.parametrize("rest", ["", "(", "OR MIT", "AND"])
def test_license_tags_without_an_expression(rest):
    assert licenses.read_tag(rest) is None


def test_shared_line_of_rows_with_one_id(spark):
    """Rows of one id that open with a shared line: that place is the first of all of them."""
    rows = [(1, "shared\na", "s1"), (1, "shared\nb", "s2"), (2, "shared\nc", "s3"), (3, "x\nshared", "s4"), (4, "shared", "s5")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted((r["doc_id"], r["text"]) for r in lines.drop_shared_lines(table, min_sites=5).collect())
    assert kept == [(1, "shared\na"), (1, "shared\nb"), (2, "c"), (3, "x"), (4, "")]


def test_kept_row_of_equal_ids_is_repeatable(spark):
    rows = [(1, "one two three four five", f"s{i}") for i in range(5)] + [(1, None, "x"), (1, "", "y"), (2, "one two three four five", "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = sorted(map(tuple, simhash.keep_one(table).collect()))
    again = sorted(map(tuple, simhash.keep_one(table.repartition(5, "source")).collect()))
    assert first == again and len(first) == 2


def test_shard_folder_is_qualified(spark, tmp_path):
    assert token_files.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert token_files.qualified(spark, f"file://{tmp_path}").startswith("file:/")


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_encoded_together_equal_pieces_alone(path):
    coder = PieceEncoder(path)
    rng = np.random.default_rng(9)
    signs = list("abcxyz019,.'!é中ßİΣ😀") + ["́"]
    lead = " " if coder.keeps_space else ""
    for size in (1, 2, 7, 300):
        bodies = [lead + rng.choice(list("abé7")) + "".join(rng.choice(signs, int(rng.integers(0, 9)))) for _ in range(size)]
        assert coder._together(bodies) == coder._one_by_one(bodies)
    # a piece that becomes longer is noticed, and all are encoded alone
    assert coder._together([f"{lead}ab", f"{lead}İx", f"{lead}cd"]) == coder._one_by_one([f"{lead}ab", f"{lead}İx", f"{lead}cd"])


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_a_word_is_encoded_once_whatever_signs_end_it(path):
    coder, met = PieceEncoder(path), []
    together = coder._together
    coder._together = lambda bodies: (met.extend(bodies), together(bodies))[1]
    texts = [" a zuberwh zuberwh, zuberwh,%%% zuberwh$$$ zuberwh&&&.", "zuberwh:: 12%% \u00e9&& x*y* 's' don't!? zuberwh#" + "!" * 90, None]
    found = [list(np.frombuffer(ids, dtype="<u4")) for ids in coder.encode(texts)]
    assert found == [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sum("zuberwh" in body for body in met) == 1
    assert all(len(p) <= 64 for p in coder.known)


class Counted(dict):
    """A dictionary that counts what is asked of it."""

    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_a_piece_is_looked_up_once_for_all_texts_of_a_call(path):
    coder = PieceEncoder(path)
    coder.known = Counted()
    texts = ["zu ber\u00fch, wh\nzu! " * 500, " zu ber\u00fch wh" * 300] * 4
    found = [list(np.frombuffer(ids, dtype="<u4")) for ids in coder.encode(texts)]
    assert found == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert coder.known.asked < 50


def test_words_after_line_breaks_are_encoded_together():
    coder, alone = PieceEncoder(BYTES), []
    one_by_one = coder._one_by_one
    coder._one_by_one = lambda bodies: (alone.extend(bodies), one_by_one(bodies))[1]
    text = "\n".join(["zuberwh", "\u00fcber", "12", "<x", "\U0001d4b3y", "zuberwh."])
    assert list(np.frombuffer(coder.encode([text])[0], dtype="<u4")) == coder.tokenizer.encode(text).ids
    assert alone == ["\n"]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_texts_of_a_call_keep_apart(path):
    coder = PieceEncoder(path)
    rng = np.random.default_rng(5)
    signs = [*"ab Z9 \n\t  .,!#'$\u00e9\u4e2d\u2014\u00a0\u0301\U0001f600\U0001d4b3\U00020000", "abc", " x.", ".\n", "!!", "\n\n", "'s"]
    for size in (0, 1, 2, 3, 40, 400):
        for _ in range(6):
            texts = ["".join(rng.choice(signs, int(rng.integers(0, 9)))) or (None if rng.random() < 0.5 else "") for _ in range(size)]
            found = [list(np.frombuffer(ids, dtype="<u4")) for ids in coder.encode(texts)]
            assert found == [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert coder.encode(["\u00a0", None, ""])[1:] == [b"", b""]


def test_cells_are_remembered_from_task_to_task():
    contents = (b" idiot  stupid ", b" good  morning ")
    cell = toxicity._remembered_cell(*contents)
    assert cell("stupid") == toxicity.Lengths(*contents).cell("stupid")
    assert toxicity._remembered_cell(*contents) is cell and cell.cache_info().currsize == 1


def plan_of(df):
    """The plans of a run, the first and the one that adaptive execution made of it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of all tables that the operators write."""
    seen = []

    def watched(df, name):
        seen.append(plan_of(df))
        return staged(df, name)

    for module in ("components", "packing", "simhash"):
        monkeypatch.setattr(f"ratinglens.llm.{module}.staged", watched)
    return seen


def test_pipeline_stages_broadcast_no_exploded_table(spark, plans):
    """Small files may be large tables: what grows with the corpus is joined by key, also where Spark takes it for small."""
    rows = [(i, f"own {i}\n shared \nlast", f"s{i % 6}") for i in range(12)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = plan_of(lines.drop_shared_lines(table, min_sites=5))
    assert "Join [a#" in cut and "BroadcastHashJoin [a#" not in cut
    plans += [plan_of(simhash.keep_one(table)), plan_of(packing.pack(table, WORDS, 1, 64))]
    assert len(plans) > 8 and not [p for p in plans if "Broadcast" in p]


def test_near_duplicates_broadcast_nothing(spark, plans, monkeypatch):
    """Also where buckets are searched further, and in the rounds of the components."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    dense = [(i, 12345 ^ sum(1 << int(b) for b in rng.choice(32, 5, replace=False))) for i in range(60)]
    plans.append(plan_of(simhash.groups(spark.createDataFrame(dense, "id long, fp long"))))
    table = spark.createDataFrame([(i, f"one two three four five {i % 3}") for i in range(9)], "doc_id long, text string")
    plans.append(plan_of(simhash.near_duplicates(table)))
    assert len(plans) > 12 and not [p for p in plans if "Broadcast" in p]


def test_a_hot_node_is_split(spark):
    """The links of one node are dealt over several tasks, without a broadcast."""
    edges = spark.range(1, 20_000, numPartitions=4).select(F.lit(0).cast("long").alias("a"), F.xxhash64("id").bitwiseAND((1 << 62) - 1).alias("b"))
    with_others = edges.union(spark.range(1, 2_000).select((F.col("id") * 1009).alias("a"), (F.col("id") * 1009 + 7).alias("b")))
    small = {f"spark.sql.adaptive.{k}": "16k" for k in ("advisoryPartitionSizeInBytes", "skewJoin.skewedPartitionThresholdInBytes")}
    small |= {"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        plan = plan_of(_large_star(with_others))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
