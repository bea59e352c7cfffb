"""Ranked lexical search: the best documents for each item, by branch and bound in trees of frequent terms.

Items are cut into blocks of a bounded number of terms. For a block, each document is reduced to the tf of the block's
terms (its restricted vector), written once to the shared folder. From that table come N, L and each term's df. A task
then builds trees over bounded numbers of documents: terms of a vector stand by falling df, so that vectors that
begin alike share a path; a node that leads to few documents, or neighbours of one path that do, is a leaf. Each node knows
its subtree's largest tf of every term and its smallest m. Both bound the score of any document below: the score rises with tf and
falls with m. For each item a depth-first search goes into the most promising child first, leaves out subtrees whose bound
lies under the tenth best score so far, and scores the documents of the leaves it reaches. A tree passes on its ten best
per item; the last ranking takes the ten best of all trees.

Null and empty texts have no terms, and such documents count nowhere. Rows that share an item id are one item with the
terms of all of them; an item with a null id is an item like others. Repeated documents each count and are each ranked; null
document ids come last among equal scores. Items without a hit have no row, an empty table gives none. Other columns are
not read. An item has to fit into a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ratinglens.llm.common import plain_words
from ratinglens.session import staged

TOP = 10
#: Terms of all items of a block, counted once an item, on average.
BLOCK_TERMS = 50_000
#: Documents and vector entries of a tree at most, and documents of a leaf.
TREE_DOCUMENTS, TREE_ENTRIES, LEAF = 8_192, 4_000_000, 64


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


def length_part(n: int, n_documents: int, n_terms: int) -> int:
    """m of a document with n terms."""
    return 100 - 90 + (90 * n * n_documents) // n_terms


def _scores(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class TermTree:
    """A tree over restricted term vectors; terms are numbered by falling frequency."""

    def __init__(self, ids: list, m: np.ndarray, terms: list[np.ndarray], tfs: list[np.ndarray], n_terms: int):
        sorts = [np.argsort(t) for t in terms]
        paths = [t[s] for t, s in zip(terms, sorts, strict=True)]
        keys = [p.astype(">u4").tobytes() for p in paths]
        order = sorted(range(len(ids)), key=keys.__getitem__)  # documents of a subtree stand next to each other
        self.ids, self.m = [ids[d] for d in order], m[order]
        self.paths = [paths[d] for d in order]
        self.low, self.high, self.children = [], [], []
        self._grow()
        sizes = np.array([len(p) for p in self.paths])
        term = np.concatenate(self.paths)
        tf = np.concatenate([tfs[d][sorts[d]] for d in order])
        place = np.repeat(np.arange(len(order)), sizes)
        by_term = np.argsort(term, kind="stable")
        self.place, self.tf = place[by_term], tf[by_term]
        self.of_term = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))
        self.m_least = np.array([self.m[a:b].min() for a, b in zip(self.low, self.high, strict=True)])
        self._subtrees(term[by_term], n_terms)
        del self.paths

    def _grow(self) -> None:
        """Nodes as ranges of documents; node 0 is the root."""

        def node(low: int, high: int) -> int:
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            return len(self.low) - 1

        open_nodes = [(node(0, len(self.paths)), 0)]
        while open_nodes:
            own, depth = open_nodes.pop()
            low, high = self.low[own], self.high[own]
            if high - low <= LEAF:
                continue
            step = np.array([p[depth] if len(p) > depth else -1 for p in self.paths[low:high]])
            while step[0] == step[-1] != -1:  # one path: no node of its own
                depth += 1
                step = np.array([p[depth] if len(p) > depth else -1 for p in self.paths[low:high]])
            cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), high - low]
            begin = 0
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > LEAF or b - begin > LEAF:
                    if a > begin:
                        self.children[own].append(node(low + begin, low + a))
                    begin = a
                if b - a > LEAF:
                    child = node(low + a, low + b)
                    self.children[own].append(child)
                    if step[a] >= 0:
                        open_nodes.append((child, depth + 1))
                    begin = b
            if begin < high - low:
                self.children[own].append(node(low + begin, high))

    def _subtrees(self, term: np.ndarray, n_terms: int) -> None:
        """For each term the nodes that hold it: largest tf, and where the node's documents stand in the term's list."""
        inner = [own for own, below in enumerate(self.children) if below]
        leaf_of = np.zeros(len(self.ids), dtype=np.int64)
        for own, below in enumerate(self.children):
            if not below:
                leaf_of[self.low[own] : self.high[own]] = own
        found = [self._maxima(term, leaf_of[self.place], np.arange(len(term)))]
        for own in inner:
            inside = np.flatnonzero((self.place >= self.low[own]) & (self.place < self.high[own]))
            found.append(self._maxima(term, np.full(len(term), own), inside))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        order = np.argsort(columns[0], kind="stable")
        term, self.node, self.most, self.begin, self.end = (c[order] for c in columns)
        self.nodes_of = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))

    def _maxima(self, term: np.ndarray, node: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
        """(term, node, largest tf, begin, end) for the runs of a term in a node."""
        term, node = term[inside], node[inside]
        starts = np.flatnonzero(np.concatenate(([len(term) > 0], (term[1:] != term[:-1]) | (node[1:] != node[:-1]))))
        ends = np.concatenate((starts[1:], [len(inside)])) - 1
        return term[starts], node[starts], np.maximum.reduceat(self.tf[inside], starts), inside[starts], inside[ends] + 1

    def best(self, terms: np.ndarray, weights: np.ndarray, top: int) -> list[tuple]:
        """The top (minus score, id is null, id) for the item with these terms."""
        spans = [np.arange(self.nodes_of[t], self.nodes_of[t + 1]) for t in terms.tolist()]
        rows = np.concatenate(spans)
        if not len(rows):
            return []
        w = np.repeat(weights, [len(s) for s in spans])
        nodes = self.node[rows]
        bounds = np.zeros(len(self.low), dtype=np.int64)
        np.add.at(bounds, nodes, _scores(w, self.most[rows], self.m_least[nodes]))
        bounds = bounds.tolist()
        kept: list[tuple] = []
        stack = [0]
        while stack:
            own = stack.pop()
            if bounds[own] <= 0 or (len(kept) == top and bounds[own] < -kept[-1][0]):
                continue
            if self.children[own]:
                stack += sorted(self.children[own], key=bounds.__getitem__)  # the most promising is taken next
                continue
            here = np.flatnonzero(nodes == own)
            lists = [np.arange(a, b) for a, b in zip(self.begin[rows[here]].tolist(), self.end[rows[here]].tolist(), strict=True)]
            entries = np.concatenate(lists)
            of_term = np.repeat(w[here], [len(x) for x in lists])
            place = self.place[entries]
            scores = np.zeros(self.high[own] - self.low[own], dtype=np.int64)
            np.add.at(scores, place - self.low[own], _scores(of_term, self.tf[entries], self.m[place]))
            least = -kept[-1][0] if len(kept) == top else 1
            for d in np.flatnonzero(scores >= least).tolist():
                doc_id = self.ids[self.low[own] + d]
                kept.append((-int(scores[d]), doc_id is None, doc_id))
            kept = sorted(kept, key=lambda k: k if k[2] is not None else (*k[:2], 0))[:top]
        return kept


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, term): each term of each item once."""
    schema = items.select(F.col(item_id).alias("item"), F.col(text).alias("term")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, body in enumerate(b.column(1).to_pylist()):
                terms = [t.decode("utf-8", "replace") for t in set(plain_words(body))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([i] * len(terms), type=pa.int32())), pa.array(terms, type=pa.string())], names=["item", "term"]
                )

    return items.select(F.col(item_id), F.col(text)).mapInArrow(run, schema).distinct()


def vectors(docs: DataFrame, doc_id: str, text: str, numbers: Broadcast) -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with terms: all its terms with repeats, and those that are numbered."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for b in batches:
            chosen, totals, ends, terms, tfs = [], [], [0], [], []
            for i, body in enumerate(b.column(1).to_pylist()):
                words = plain_words(body)
                if not words:
                    continue
                tf = Counter(words)
                held = tf.keys() & known.keys()
                terms += [known[t] for t in held]
                tfs += [tf[t] for t in held]
                chosen.append(i)
                totals.append(len(words))
                ends.append(len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(x, type=pa.int32())) for x in (terms, tfs)]
            ids = b.column(0).take(pa.array(chosen, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(totals, type=pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])

    narrow = docs.select(F.col(doc_id), F.col(text))
    return narrow.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def _searched(rows: DataFrame, block: Broadcast, item_type: str, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best of each tree."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    arrow = [to_arrow_type(t) for t in (block.value["item_type"], rows.schema["doc_id"].dataType)] + [pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for row in _rows(b, block.value["rank"]):
                held.append(row)
                size += len(row[2])
                if len(held) >= TREE_DOCUMENTS or size >= TREE_ENTRIES:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    def pack(held: list[tuple]) -> pa.RecordBatch:
        ids, n, terms, tfs = zip(*held, strict=True)
        known = block.value
        m = np.array([length_part(x, known["documents"], known["terms"]) for x in n], dtype=np.int64)
        tree = TermTree(list(ids), m, list(terms), list(tfs), len(known["weight"]))
        out = [
            (item, found[2], -found[0])
            for item, own in known["items"]
            for found in tree.best(own, known["weight"][own], top)
        ]
        columns = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, arrow, strict=True)], names=["item_id", "doc_id", "score"]
        )

    return rows.where(F.size("terms") > 0).mapInArrow(run, f"item_id {item_type}, doc_id {kind}, score long")


def _rows(b: pa.RecordBatch, rank: np.ndarray) -> Iterable[tuple]:
    ends = b.column(2).offsets.to_numpy()
    terms = rank[b.column(2).values.to_numpy()]
    tfs = b.column(3).values.to_numpy().astype(np.int64)
    for i, (doc_id, n) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
        own = slice(ends[i], ends[i + 1])
        yield doc_id, n, terms[own], tfs[own]


def rank_documents(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of each item with a score above 0."""
    if top < 1:
        raise ValueError("top from 1")
    spark = docs.sparkSession
    wanted = staged(item_terms(items, item_id, item_text), "item-terms")
    item_type, id_type = wanted.schema["item"].dataType, docs.schema[doc_id].dataType.simpleString()
    n_blocks = -(-wanted.count() // BLOCK_TERMS)
    found = spark.createDataFrame([], f"item_id {item_type.simpleString()}, doc_id {id_type}, score long")
    for block in range(n_blocks):
        of_block = F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block
        rows = wanted.where(of_block).groupBy("item").agg(F.collect_list("term").alias("terms")).collect()
        numbers = {t: i for i, t in enumerate(sorted({t for r in rows for t in r.terms}))}
        coded = spark.sparkContext.broadcast({t.encode(): i for t, i in numbers.items()})
        table = staged(vectors(docs, doc_id, text, coded), "term-vectors")
        n, total = table.agg(F.count("*"), F.sum("n")).first()
        df = np.zeros(len(numbers), dtype=np.int64)
        for term, number in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the block's terms
            df[term] = number
        order = np.argsort(-df, kind="stable")
        rank = np.argsort(order)
        known = {
            "rank": rank, "documents": n, "terms": total, "item_type": item_type,
            "weight": np.array([weight(n, int(df[t])) for t in order], dtype=np.int64),
            "items": [(r.item, np.sort(rank[[numbers[t] for t in r.terms]])) for r in rows],
        }
        shared = spark.sparkContext.broadcast(known)
        best = _ranked(_searched(table, shared, item_type.simpleString(), top), top).drop("rank")
        if n_blocks > 1:  # one block at a time
            best = staged(best, "ranked")
            coded.unpersist()
            shared.unpersist()
        found = found.union(best)
    return _ranked(found, top).select("item_id", "rank", "doc_id", "score")


def _ranked(found: DataFrame, top: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= top)


def sql(top: int = TOP) -> str:
    """The ranking as SQL over `documents` and `benchmark`."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents
), sized AS (
  SELECT r, doc_id, len(words)::BIGINT AS n FROM d WHERE len(words) > 0
), total AS (
  SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM sized
), i AS (
  SELECT DISTINCT item_id, unnest({words}) AS term FROM benchmark
), v AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY r, term
), w AS (
  SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM v, total GROUP BY term
), s AS (
  SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN v USING (term) JOIN sized USING (r), total GROUP BY item_id, r
), ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
  FROM s JOIN sized USING (r) WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= {top}"""
