"""Each registered query against a plain computation on the smallest tables."""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash
from tokenizers import Tokenizer

from check import compare, connect
from ratinglens.llm.queries import QUERIES, SQL
from ratinglens.llm.tokens import tokenizer_file

SF_DIR = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@pytest.fixture(scope="module")
def texts():
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    return dict(zip(docs.doc_id, docs.text, strict=True))


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).toPandas()


def by_id(frame):
    return {row["doc_id"]: row for row in frame.to_dict("records")}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_simhash(spark, texts):
    def fingerprint(text):
        words = SPACED.findall(text.translate(LOWER))
        if not words:
            return 0
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {i: fingerprint(t) for i, t in texts.items()}
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and least[b] < least[a]:
                    least[a], changed = least[b], True
    got = by_id(result(spark, "op1_simhash_dedup"))
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {
        i: (f"{prints[i]:016x}", least[i]) for i in prints
    }


def encoded(texts, name, end):
    coder = Tokenizer.from_file(tokenizer_file(name))
    coder.encode_special_tokens = True
    return {i: coder.encode(t, add_special_tokens=False).ids + [end] for i, t in texts.items()}


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_packing(spark, texts):
    got = result(spark, "op2_best_fit_packing")
    pieces = {
        (i, k): (at, len(ids[at : at + 4096]), crc(ids[at : at + 4096]))
        for i, ids in encoded(texts, "word_bpe_49k.json", 1).items()
        for k, at in enumerate(range(0, len(ids), 4096))
    }
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == pieces
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        assert own.length.sum() <= 4096
    rooms, opened = [], 0
    for length in sorted(got.length, reverse=True):
        at = bisect.bisect_left(rooms, length)
        room = rooms.pop(at) if at < len(rooms) else 4096
        opened += at >= len(rooms) and room == 4096
        bisect.insort(rooms, room - length)
    assert got.sequence_id.nunique() == opened


def test_token_files(spark, texts):
    got = by_id(result(spark, "op3_token_files"))
    at = 0
    for i, ids in sorted(encoded(texts, "byte_bpe_50k.json", 0).items()):
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)


def test_licenses(spark, texts):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    got = by_id(result(spark, "op4_license_scan"))
    assert any(r["n_base"] for r in got.values())
    for i, text in texts.items():
        words = PLAIN.findall(text.translate(LOWER))
        places = [
            (k, label)
            for phrase, label in phrases.items()
            for k in range(len(words))
            if words[k : k + len(phrase.split())] == phrase.split()
        ]
        row = got[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        if places:
            assert (row["first_word"], row["last_word"]) == (min(places)[0], max(places)[0])
        assert 0 <= row["score"] <= 1


def test_substrings(spark, texts):
    words = {i: SPACED.findall(t) for i, t in texts.items()}
    seen = Counter(tuple(w[k : k + 35]) for w in words.values() for k in range(len(w) - 34))
    got = by_id(result(spark, "op5_substring_dedup"))
    assert sum(r["n_removed"] for r in got.values()) > 0
    for i, own in words.items():
        gone = {j for k in range(len(own) - 34) if seen[tuple(own[k : k + 35])] > 1 for j in range(k, k + 35)}
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(own), len(gone), sha(kept))


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) == ""


def test_toxicity_on_held_out_rows(spark):
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    scored = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    rows = scored[scored.held_out].merge(labels, on="doc_id")
    # outside English, this table marks toxic rows by words that ordinary rows share
    assert rows[rows.toxic == 1].predicted.mean() > 0.6
    assert rows[rows.toxic == 0].predicted.mean() < 0.02
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.5) == (scored.predicted == 1)).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored.doc_id]).all()


def test_toxicity_finds_marks_in_every_language(spark):
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    langs = pd.read_parquet("/root/testdata/sf0.1/documents.parquet", columns=["doc_id", "lang"])
    scored = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    rows = scored[scored.held_out].merge(labels, on="doc_id").merge(langs, on="doc_id")
    assert rows[rows.toxic == 1].predicted.mean() > 0.9 and rows[rows.toxic == 0].predicted.mean() < 0.01
    assert rows[rows.toxic == 1].groupby("lang").predicted.mean().min() > 0.8


def test_decontamination(spark, texts):
    items = pd.read_parquet(f"{SF_DIR}/benchmark.parquet")
    windows = defaultdict(set)
    for item, text in zip(items.item_id, items.text, strict=True):
        own = PLAIN.findall(text.translate(LOWER))
        for k in range(max(1, len(own) - 9)):
            windows[tuple(own[k : k + 10])].add(str(item))
    got = by_id(result(spark, "op8_decontamination"))
    assert any(r["contaminated"] for r in got.values())
    for i, text in texts.items():
        own, hit, found = PLAIN.findall(text.translate(LOWER)), set(), set()
        for width in {len(w) for w in windows} - {0}:
            for k in range(len(own) - width + 1):
                if names := windows.get(tuple(own[k : k + width])):
                    hit |= set(range(k, k + width))
                    found |= names
        row = got[i]
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (len(own), len(hit), len(found))
        assert (row["items_sha256"], row["contaminated"]) == (sha(",".join(sorted(found))), bool(hit))


def test_quality(spark, texts):
    got = by_id(result(spark, "op9_quality_rules"))
    for i, text in texts.items():
        words = SPACED.findall(text)
        lines = [line for line in text.split("\n") if SPACED.search(line)]
        count = Counter(zip(words, words[1:], words[2:], strict=False))
        grams = list(zip(words, words[1:], words[2:], strict=False))
        covered = {j for k, g in enumerate(grams) if count[g] > 1 for j in (k, k + 1, k + 2)}
        row = got[i]
        assert (row["n_words"], row["word_chars"]) == (len(words), sum(map(len, words)))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert (row["n_dup_lines"], row["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))
        assert row["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (row["base_failed"] and row["kept"])


def test_quality_keeps_good_documents(spark):
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    judged = QUERIES["op9_quality_rules"](spark, "/root/testdata/sf0.01").toPandas().merge(labels, on="doc_id")
    assert judged[(judged.quality == 1) & ~judged.base_failed].kept.mean() > 0.99
    assert judged[judged.quality == 0].kept.mean() < 0.05


def test_language_on_held_out_rows(spark):
    docs = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")[["doc_id", "lang"]]
    found = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").toPandas().merge(docs, on="doc_id")
    rows = found[found.held_out]
    assert (rows.lang_pred == rows.lang).mean() > 0.98
    assert found.score.between(0, 1).all()


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF_DIR)
        if k < 4:
            assert docs.columns == columns
            docs = docs.cache()
            sizes.append(docs.count())
    packed = docs.toPandas()
    assert sizes == sorted(sizes, reverse=True) and packed.doc_id.nunique() == sizes[-1]
    whole = QUERIES["pipeline"](spark, SF_DIR).toPandas()
    order = ["doc_id", "piece"]
    same = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert whole.sort_values(order)[same].values.tolist() == packed.sort_values(order)[same].values.tolist()


def links_of(prints):
    """The smallest id that each id reaches over fingerprints that differ in at most four bits."""
    least = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4 and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def without_shared_lines(docs):
    """Lines on five sources or more, but for their first place."""
    sites, first = defaultdict(set), {}
    for i, (text, source) in sorted(docs.items()):
        for k, line in enumerate(text.split("\n")):
            if line := line.strip(" \t\n\x0b\f\r"):
                sites[line].add(source)
                first.setdefault(line, (i, k))
    out = {}
    for i, (text, _) in docs.items():
        stripped = [(k, line, line.strip(" \t\n\x0b\f\r")) for k, line in enumerate(text.split("\n"))]
        out[i] = "\n".join(line for k, line, bare in stripped if not bare or len(sites[bare]) < 5 or first[bare] == (i, k))
    return out


def without_windows(text, windows):
    """The text without the words that a window covers, and what stands between such words."""
    found = list(PLAIN.finditer(text.translate(LOWER)))
    spans, own = [m.span() for m in found], [m.group() for m in found]
    hit = set()
    for width in {len(w) for w in windows} - {0}:
        hit |= {j for k in range(len(own) - width + 1) if tuple(own[k : k + width]) in windows for j in range(k, k + width)}
    cut = set()
    for j in hit:
        cut |= set(range(*spans[j]))
        if j + 1 in hit:
            cut |= set(range(spans[j][1], spans[j + 1][0]))
    return "".join(c for k, c in enumerate(text) if k not in cut)


def test_pipeline_equals_a_plain_one(spark):
    """Given the decisions of the language stage, all other stages in plain Python."""
    import corpus_pipeline

    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stays = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, table, SF_DIR).collect()}
    frame = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    docs = {r.doc_id: (r.text, r.source) for r in frame.itertuples() if r.doc_id in stays}
    texts = without_shared_lines(docs)
    prints = {}
    for i, text in texts.items():
        words = SPACED.findall(text.translate(LOWER))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]), 42) for k in range(max(1, len(words) - 3))] if words else []
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    texts = {i: texts[i] for i, least in links_of(prints).items() if i == least}
    windows = set()
    for text in pd.read_parquet(f"{SF_DIR}/benchmark.parquet").text:
        own = PLAIN.findall(text.translate(LOWER))
        windows |= {tuple(own[k : k + 10]) for k in range(max(1, len(own) - 9))}
    texts = {i: without_windows(text, windows) for i, text in texts.items()}
    want = {
        (i, k, at, len(ids[at : at + 4096]), crc(ids[at : at + 4096]))
        for i, ids in encoded(texts, "word_bpe_49k.json", 1).items()
        for k, at in enumerate(range(0, len(ids), 4096))
    }
    got = QUERIES["pipeline"](spark, SF_DIR).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert len(texts) < len(docs)


def test_pipeline_on_odd_tables(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    words = " ".join(f"word{k}" for k in range(60))
    rows = [
        (1, f"the first text {words}", "en"), (1, f"the first text {words}", "en"), (None, "ein anderer Text ohne Nummer", "de"),
        (None, "ein anderer Text ohne Nummer", None), (2, None, "en"), (3, "", "en"), (4, "... 12", "en"), (5, "le dernier texte de la table", "fr"),
    ]
    for name, some in (("some", rows), ("none", [])):
        table = spark.createDataFrame([(i, t, lang, "s", None, "x") for i, t, lang in some], schema)
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/some").collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 1, 5]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
