"""Ranked lexical search by a dual tree over items (queries) and documents, exact in integers.

Terms are runs of letters and digits, ASCII lower-cased. A document's impact on a term is
``weight * ((10^9 * tf) div (10^3 * tf + 12 * m))``, where the weight falls with the number of documents
that hold the term and ``m`` grows with the document's length; its score for an item is the sum of
its impacts over the item's terms, repeats included.

One pass over the texts writes, per document, its number of terms and the counts of the terms that any
item of the block holds. Statistics are sums over all documents. The items of a block, bounded by their
number of terms, go to all tasks with their tree: items lie in leaves, similar ones side by side,
and a node holds the maximum of each term's number over its items. Every task puts the documents
of a batch into a tree of its own, whose nodes hold the maximum impact on each term. The product of the
maxima of an item node and a document node bounds the score of every item and document below; a pair of
nodes is dropped as a whole if that bound is below the weakest k-th score among its items. Pairs that
remain are opened, down to single documents, which are scored exactly. A pair equal to the bound stays,
so ties are whole.

The k-th scores start from a first round over a part of the documents chosen by hash; a k-th score of any
part is a true lower bound, so the part changes the work and never the result.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut, to_table
from .columns import few_rows
from .words import NO_LETTERS, slices, words_of

#: Bytes of item texts that are searched in one pass over the documents.
BLOCK_BYTES = 2 << 20
#: Terms of an item group, and cells of a table of documents by terms, that a task holds at a time.
GROUP_TERMS, CELLS = 4096, 1 << 21
#: Items of a leaf and children of a node of items; documents of a leaf and children of a node of documents.
ITEM_FAN, DOC_FAN = 8, 8
#: One of this many documents, by hash, is searched first.
FIRST = 32
#: Parts into which the candidates of an item are ranked before they are ranked as a whole.
PARTS = 64


@dataclass
class ItemNode:
    """Items that lie together: the largest number of each term in them, and the nodes below (none at an item)."""

    terms: np.ndarray
    numbers: np.ndarray
    items: list[int]
    below: list["ItemNode"]


def _joined(nodes: list[ItemNode]) -> ItemNode:
    terms, place = np.unique(np.concatenate([n.terms for n in nodes]), return_inverse=True)
    numbers = np.zeros(len(terms), np.int64)
    np.maximum.at(numbers, place, np.concatenate([n.numbers for n in nodes]))
    return ItemNode(terms, numbers, [i for n in nodes for i in n.items], nodes)


def item_tree(items: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> list[ItemNode]:
    """Roots of at most ``GROUP_TERMS`` different terms (or one item) over items given as term places and numbers.

    Items are ordered by their heaviest terms, so that items which share rare terms lie side by side.
    """
    def heaviest(i: int) -> tuple:
        terms = items[i][0]
        top = np.lexsort((terms, -weights[terms]))[:4]
        return tuple(terms[top].tolist())

    leaves = [ItemNode(*items[i], [i], []) for i in sorted((i for i in range(len(items)) if len(items[i][0])), key=heaviest)]
    roots: list[ItemNode] = []
    group: list[ItemNode] = []
    seen: set[int] = set()
    for leaf in [*leaves, None]:
        more = seen.union(leaf.terms.tolist()) if leaf else set()
        if group and (leaf is None or len(more) > GROUP_TERMS):
            while len(group) > 1:
                group = [_joined(group[i:i + ITEM_FAN]) if len(group[i:i + ITEM_FAN]) > 1 else group[i]
                         for i in range(0, len(group), ITEM_FAN)]
            roots.append(group[0])
            group, more = [], set(leaf.terms.tolist()) if leaf else set()
        if leaf:
            group.append(leaf)
            seen = more
    return roots


class Best:
    """The k best (score, document) of each item so far, and the weakest k-th score a document must reach."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in least]

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        keep = scores >= self.least[item]
        if not keep.any():
            return
        scores, docs = (np.concatenate(x) for x in zip(self.found[item], (scores[keep], docs[keep])))
        if len(scores) > self.k:
            top = np.lexsort((docs, -scores))[:self.k]
            scores, docs = scores[top], docs[top]
            self.least[item] = max(self.least[item], scores[-1])
        self.found[item] = scores, docs


def doc_levels(impacts: np.ndarray) -> list[np.ndarray]:
    """Maxima over documents, level by level from the documents up to one node; row i's parent is row i // DOC_FAN."""
    levels = [impacts]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append(np.maximum.reduceat(low, np.arange(0, len(low), DOC_FAN), axis=0))
    return levels


def search(root: ItemNode, levels: list[np.ndarray], docs: np.ndarray, best: Best) -> int:
    """Take the documents of a tree into ``best`` for the items below ``root``; the number of exact scores made.

    Columns of ``levels`` are the root's terms. A pair of nodes that stays opens its items first, as maxima over items with
    different terms are far looser than those over documents; then the documents of the rows that stayed.
    """
    scored = 0
    stack = [(root, len(levels) - 1, np.arange(len(levels[-1])))]
    while stack:
        node, level, rows = stack.pop()
        columns = np.searchsorted(root.terms, node.terms)
        bounds = levels[level][rows[:, None], columns] @ node.numbers
        if not level and not node.below:
            scored += len(rows)
            best.add(node.items[0], bounds, docs[rows])
            continue
        rows = rows[bounds >= min(best.least[node.items])]
        if not len(rows):
            continue
        if node.below:
            stack.extend((child, level, rows) for child in node.below)
        else:
            rows = (rows[:, None] * DOC_FAN + np.arange(DOC_FAN)).ravel()
            stack.append((node, level - 1, rows[rows < len(levels[level - 1])]))
    return scored


class Block:
    """The items of one pass: their ids, terms and numbers of terms."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        self.ids = [r[0] for r in rows]
        hashes = []
        for _, _, data, offsets in slices(pa.array([r[1] for r in rows], pa.string())):
            words = words_of(data, offsets, NO_LETTERS)
            hashes.extend(words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:]))
        self.vocabulary = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]))
        self.items = []
        for own in hashes:
            terms, numbers = np.unique(own, return_counts=True)
            self.items.append((np.searchsorted(self.vocabulary, terms), numbers.astype(np.int64)))


def _counts_of(column, vocabulary: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of terms, places of the block's terms, and their counts in each text."""
    for _, _, data, offsets in slices(column):
        words = words_of(data, offsets, NO_LETTERS)
        place = np.searchsorted(vocabulary, words.hashes)
        place[place == len(vocabulary)] = 0
        hit = np.flatnonzero(vocabulary[place] == words.hashes) if len(vocabulary) else place[:0]
        text_of = np.searchsorted(words.first, hit, "right") - 1
        pairs, counts = np.unique(text_of * max(len(vocabulary), 1) + place[hit], return_counts=True)
        text_of, terms = np.divmod(pairs, max(len(vocabulary), 1))
        edges = np.searchsorted(text_of, np.arange(len(offsets)))
        for row, n in enumerate(words.counts.tolist()):
            a, b = edges[row], edges[row + 1]
            yield n, terms[a:b], counts[a:b]


def term_counts(docs: DataFrame, vocabulary: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc, n, terms, counts)`` of each row with a term; ``terms`` are places in ``vocabulary`` (sorted hashes)."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names, lists = ["doc", "n", "terms", "counts"], pa.list_(pa.int64())

    def run(batches):
        for batch in few_rows(batches):
            n, terms, counts = list(zip(*_counts_of(batch.column(1), known.value))) or ((),) * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(terms, lists),
                                              pa.array(counts, lists)], names=names)

    found = docs.select(F.col(key).cast("long"), F.col(text).cast("string"))
    return found.mapInArrow(run, "doc long, n long, terms array<long>, counts array<long>").where("n > 0")


def weight(total: int, holders: int) -> int:
    return floor(1000 * log((2 * total + 2) / (2 * holders + 1)))


def impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return weights * (1_000_000_000 * counts // (1000 * counts + 12 * lengths))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best documents of each item with their ranks; ranked by parts first, so no item's candidates meet at once."""
    order = [F.col("score").desc(), F.col("doc")]
    part = F.pmod(F.xxhash64("doc"), F.lit(PARTS))
    few = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", part).orderBy(*order))).where(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _searched(vectors: DataFrame, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, k: int,
              least: np.ndarray) -> DataFrame:
    """``(item, score, doc)``: the k best documents of each item in each task, of those that reach ``least``."""
    shared = vectors.sparkSession.sparkContext.broadcast((item_tree(block.items, weights), weights, least))

    def run(batches):
        roots, weights, least = shared.value
        best = Best(k, least)
        for batch in few_rows(batches):
            docs, n, terms, counts = (batch.column(i) for i in range(4))
            edges = np.asarray(terms.offsets) - terms.offsets[0].as_py() if batch.num_rows else np.zeros(1, np.int64)
            docs, terms, counts = docs.to_numpy(), terms.flatten().to_numpy(), counts.flatten().to_numpy()
            row_of = np.repeat(np.arange(len(docs)), np.diff(edges))
            lengths = 100 - 25 + 25 * n.to_numpy() * n_docs // n_terms
            values = impacts(weights[terms], counts, lengths[row_of])
            for root in roots:
                step = max(DOC_FAN, CELLS // len(root.terms))
                for low in range(0, len(docs), step):
                    a, b = edges[low], edges[min(low + step, len(docs))]
                    column = np.searchsorted(root.terms, terms[a:b])
                    column[column == len(root.terms)] = 0
                    held = root.terms[column] == terms[a:b]
                    rows, place = np.unique(row_of[a:b][held], return_inverse=True)
                    if not len(rows):
                        continue
                    table = np.zeros((len(rows), len(root.terms)), np.int64)
                    table[place, column[held]] = values[a:b][held]
                    # documents with the same strongest term side by side, for tighter maxima
                    order = np.argsort(table.argmax(axis=1), kind="stable")
                    search(root, doc_levels(table[order]), docs[rows[order]], best)
        found = [(i, *pair) for i, pair in enumerate(best.found) if len(pair[0])]
        for item, scores, docs in found:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), item, np.int64)), pa.array(scores, pa.int64()),
                                              pa.array(docs, pa.int64())], names=["item", "score", "doc"])

    return vectors.mapInArrow(run, "item long, score long, doc long")


def ranked(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
           item_key: str = "item_id", k: int = 20) -> DataFrame:
    """``(item_key, rank, key, score)``: the ``k`` highest-scoring documents of each item, equal scores by ascending key.

    Only scores above 0 count, so an item may have fewer rows, and one without known terms none. Null texts have no
    terms. Every row with a term counts in the statistics, repeated rows each; a row with a null key counts too
    but is not ranked. Items that repeat id and text are one item; items that share an id but differ in text are ranked
    apart, and a null item id is an id like others. Empty tables give no rows. Other columns are ignored.

    Items go in blocks of ``BLOCK_BYTES``, each one pass over the texts, so neither their number nor the documents are bounded.
    """
    spark = docs.sparkSession
    given = cut(items.where(F.col(item_text).isNotNull()).select(
        F.col(item_key).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).distinct())
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // BLOCK_BYTES))
    results = None
    for part in range(parts):
        rows = given.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).orderBy("id", "text").collect()
        block = Block([tuple(r) for r in rows])
        vectors = to_table(term_counts(docs, block.vocabulary, text, key), "term_counts")
        n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
        weights = np.zeros(len(block.vocabulary), np.int64)
        for term, holders in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[term] = weight(n_docs, holders)
        named = vectors.where(F.col("doc").isNotNull() & (F.size("terms") > 0))
        least = np.ones(len(rows), np.int64)

        def found_in(some: DataFrame) -> DataFrame:
            return _ranked(_searched(some, block, weights, n_docs, n_terms or 1, k, least), k)

        for row in found_in(named.where(F.pmod(F.xxhash64("doc"), F.lit(FIRST)) == 0)).where(F.col("rank") == k).collect():
            least[row.item] = max(1, row.score)
        ids = spark.createDataFrame([(i, x) for i, x in enumerate(block.ids)], "item long, id long")
        one = found_in(named).join(F.broadcast(ids), "item").select(
            F.col("id").alias(item_key), "rank", F.col("doc").alias(key), "score")
        results = one if results is None else results.unionByName(one)
    return results
