"""Long exact spans shared between documents: seeds, chains, passages.

*Seeds.*  Every window of ``span`` code points has a minimiser: the k-mer with the
least hash in it.  Equal windows have equal minimisers, so a passage of ``span``
code points that two documents share gives a seed both have.  Seeds that only
one document has are dropped; what is left is a few percent of the corpus.

*Shared windows.*  Windows with one minimiser lie in a row and form a block.
Equal blocks collapse, before any shuffle of theirs, into one row with the first
and the last document that have them.  Where a seed has several different blocks
their windows are compared in the same manner, equal windows of one block as
one.  Neither a seed nor a copied text that a third of all documents hold makes
any group grow: there are no pairs within a group.  The union of a document's
shared windows is what it shares verbatim; no chain can add to it or take away.

*Passages.*  The first and the last holder of a window tell what is shared, not with whom.  There exact
copies collapse into one text, blocks of different texts are linked where they have a window in common, and
every two texts that share one are chained with each other.

*Chains.*  The matches of two texts are chained: collinear matches in order,
with a gap cost, by a Fenwick tree over the partner's positions.  Each match
lies in exactly one chain.  A chain is a passage, exact in its matches and fuzzy
between them, where the two texts are aligned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoweave.session import reliable

#: Length of the seeds' k-mers.  Longer ones are fewer by chance (phrases are shared far below ``span``) but denser.
SEED = 48
#: Code points that are hashed at once in a worker.
CHUNK = 1 << 20
#: Cost of one code point of gap, in code points of match.
GAP_COST = 0.25

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK + 4096), base, dtype=np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _POWERS[base] = known
    return known[:n]


def _scramble(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words, so that neither low bits nor small values are special."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def kmer_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k-mer of a code point array, by prefix sums of a polynomial modulo 2**64."""
    n = len(points)
    terms = _scramble(points.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * _powers(_BASE, n)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms, out=prefix[1:])
    return _scramble((prefix[k:] - prefix[:-k]) * _powers(_BASE_INV, n - k + 1))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by doubling."""
    best, reach = values, 1
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best


def _pieces(texts: list[str | None], span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of whole or partial texts of about ``CHUNK`` code points: points, and per piece its text, first position, and start in the run.

    A text beyond ``CHUNK`` is cut with an overlap of ``span - 1``, so each window lies in exactly one piece.
    """
    points: list[np.ndarray] = []
    owner: list[int] = []
    first: list[int] = []
    held = 0
    for i, text in enumerate(texts):
        if text is None or len(text) < span:
            continue
        whole = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for at in range(0, len(whole) - span + 1, CHUNK):
            part = whole[at : at + CHUNK + span - 1]
            points.append(part)
            owner.append(i)
            first.append(at)
            held += len(part)
            if held >= CHUNK:
                yield _joined(points, owner, first)
                points, owner, first, held = [], [], [], 0
    if points:
        yield _joined(points, owner, first)


def _joined(points, owner, first):
    starts = np.cumsum([0, *map(len, points)])
    return np.concatenate(points), np.array(owner), np.array(first), starts


def _minimisers(points: np.ndarray, starts: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser of each window of a run, and a mask of the windows that lie in one piece.  A ``span`` below ``k`` is its own seed."""
    k = min(k, span)
    least = sliding_min(kmer_hashes(points, k), span - k + 1)
    return least, _whole_windows(len(least), starts, span)


def _whole_windows(n: int, starts: np.ndarray, span: int) -> np.ndarray:
    """Mask of the ``n`` windows of a run that lie in one piece."""
    valid = np.ones(n, dtype=bool)
    for end in starts[1:-1]:
        valid[max(0, end - span + 1) : end] = False
    return valid


def document_seeds(documents: DataFrame, span: int, k: int = SEED) -> DataFrame:
    """``h, doc_id``: the distinct minimisers of each document of at least ``span`` code points."""
    if span < 1 or k < 1:
        raise ValueError(f"passages and seeds have at least one code point, not {span} and {k}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for points, owner, _, starts in _pieces(batch.column(1).to_pylist(), span):
                least, valid = _minimisers(points, starts, span, k)
                lengths = np.diff(starts)
                whose = np.repeat(owner, lengths)[: len(least)]
                new = valid.copy()
                new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1] | (whose[1:] != whose[:-1])
                seeds, docs = least[new], whose[new]
                order = np.lexsort((seeds, docs))
                seeds, docs = seeds[order], docs[order]
                once = np.ones(len(seeds), dtype=bool)
                once[1:] = (seeds[1:] != seeds[:-1]) | (docs[1:] != docs[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(seeds[once].view(np.int64)), pa.array(ids[docs[once]])], names=["h", "doc_id"])

    return documents.select("doc_id", "text").mapInArrow(run, "h bigint, doc_id bigint")


def seed_blocks(documents: DataFrame, span: int, k: int = SEED) -> DataFrame:
    """``h, doc_id, at, body`` of the blocks whose minimiser is in the document's list ``hs``.

    ``body`` is the text from the block's first window to the end of its last; ``at`` is its position.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).to_pylist()
            lists = batch.column(2)
            for points, owner, first, starts in _pieces(texts, span):
                least, valid = _minimisers(points, starts, span, k)
                # a seed that is shared is shared for all documents of the run
                shared = np.unique(np.concatenate([np.asarray(lists[int(i)].values) for i in np.unique(owner)])).view(np.uint64)
                change = np.ones(len(least), dtype=bool)
                change[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
                change &= valid
                begins = np.flatnonzero(change)
                # a block ends where another begins or its windows leave the piece
                stop = change | ~valid
                ends = np.append(np.flatnonzero(stop), len(least))
                ends = ends[np.searchsorted(ends, begins, side="right")]
                keep = np.isin(least[begins], shared)
                begins, ends = begins[keep], ends[keep]
                piece = np.searchsorted(starts, begins, side="right") - 1
                docs, at = owner[piece], first[piece] + begins - starts[piece]
                bodies = [texts[d][a : a + n + span - 1] for d, a, n in zip(docs.tolist(), at.tolist(), (ends - begins).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(least[begins].view(np.int64)), pa.array(ids[docs]), pa.array(at.astype(np.int64)), pa.array(bodies, pa.string())],
                    names=["h", "doc_id", "at", "body"],
                )

    return documents.select("doc_id", "text", "hs").mapInArrow(run, "h bigint, doc_id bigint, at bigint, body string")


def body_runs(bodies: DataFrame, span: int) -> DataFrame:
    """``h, s, a, z, whole, g, runs`` per distinct window of each body ``h, s, a, z, whole, body``: its hash and the places
    ``(j, n)``, windows ``j .. j + n - 1``, where the body has it.  A body of one sign has one distinct window."""
    names = ["h", "s", "a", "z", "whole", "g", "runs"]
    place = pa.struct([("j", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for points, owner, first_at, starts in _pieces(batch.column("body").to_pylist(), span):
                g = kmer_hashes(points, span)
                valid = _whole_windows(len(g), starts, span)
                piece = np.searchsorted(starts, np.arange(len(g)), side="right") - 1
                fresh = valid.copy()
                fresh[1:] &= (g[1:] != g[:-1]) | ~valid[:-1] | (piece[1:] != piece[:-1])
                begins = np.flatnonzero(fresh)  # equal windows in a row are one run
                stop = np.append(np.flatnonzero(fresh | ~valid), len(g))
                lengths = stop[np.searchsorted(stop, begins, side="right")] - begins
                body, values = owner[piece[begins]], g[begins]
                at = begins - starts[piece[begins]] + first_at[piece[begins]]
                order = np.lexsort((at, values, body))
                body, values = body[order], values[order]
                first = np.flatnonzero(np.append(True, (values[1:] != values[:-1]) | (body[1:] != body[:-1])))
                runs = pa.StructArray.from_arrays([pa.array(at[order].astype(np.int64)), pa.array(lengths[order].astype(np.int64))], fields=list(place))
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), runs)
                whose = pa.array(body[first].astype(np.int64))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(whose) for c in names[:5]), pa.array(values[first].view(np.int64)), lists], names=names)

    return bodies.select(*names[:5], "body").mapInArrow(
        run, "h bigint, s bigint, a bigint, z bigint, whole boolean, g bigint, runs array<struct<j:bigint,n:bigint>>"
    )


def block_hits(blocks: DataFrame, span: int) -> DataFrame:
    """``h, s, hits`` per distinct block with a window that another document has too.

    A hit ``(j, n)`` is a run of such windows, ``j .. j + n - 1``.  Memory per row follows the length of one body.
    """
    distinct = (
        blocks.groupBy("h", "s")
        .agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.min("body").alias("body"))
        .withColumn("whole", F.col("a") != F.col("z"))
    )
    everything = F.struct(F.lit(0).cast("bigint").alias("j"), (F.char_length("body") - (span - 1)).cast("bigint").alias("n"))
    whole = distinct.where("whole").select("h", "s", F.array(everything).alias("hits"))
    several = distinct.groupBy("h").agg(F.count("*").alias("c"), F.min("whole").alias("all_whole")).where((F.col("c") > 1) & ~F.col("all_whole")).select("h")
    windows = body_runs(distinct.join(several, "h", "left_semi"), span)
    met = windows.groupBy("h", "g").agg(F.min("a").alias("lo"), F.max("z").alias("hi")).where("lo <> hi").select("h", "g")
    single = (
        windows.where(~F.col("whole"))
        .select("h", "s", "g", "runs")
        .join(met, ["h", "g"], "left_semi")
        .groupBy("h", "s")
        .agg(F.flatten(F.collect_list("runs")).alias("hits"))
    )
    return whole.unionByName(single)


def shared_blocks(texts: DataFrame, span: int, k: int) -> DataFrame:
    """``h, doc_id, at, body, s`` of the blocks whose seed several of the given texts have; ``s`` is the hash of the body."""
    seeds = document_seeds(texts, span, k)
    shared = seeds.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    wanted = seeds.join(shared, "h", "left_semi").groupBy("doc_id").agg(F.collect_list("h").alias("hs"))
    return seed_blocks(texts.join(wanted, "doc_id"), span, k).withColumn("s", F.xxhash64("body"))


def matches(documents: DataFrame, span: int = 100, k: int = SEED) -> DataFrame:
    """``doc_id, found``: per document its matches ``(at, hits)``, in no order; only documents that share something."""
    texts = documents.where(F.col("doc_id").isNotNull() & (F.char_length("text") >= span)).select("doc_id", "text")
    blocks = shared_blocks(texts, span, k)
    hits = block_hits(blocks, span)
    return (
        blocks.select("h", "s", "doc_id", "at")
        .join(hits, ["h", "s"])
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("at", "hits")).alias("found"))
    )


def body_windows(bodies: DataFrame, span: int) -> DataFrame:
    """``h, s, j, g, r``: the windows of each body, by hash; ``r`` counts the earlier windows of the body that equal window ``j``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, s, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                g = kmer_hashes(np.frombuffer(body.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), span)
                order = np.argsort(g, kind="stable")
                fresh = np.ones(len(g), dtype=bool)
                fresh[1:] = g[order][1:] != g[order][:-1]
                places = np.arange(len(g))
                r = np.empty(len(g), dtype=np.int64)
                r[order] = places - np.maximum.accumulate(np.where(fresh, places, 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(g), h)), pa.array(np.full(len(g), s)), pa.array(places), pa.array(g.view(np.int64)), pa.array(r)],
                    names=["h", "s", "j", "g", "r"],
                )

    return bodies.select("h", "s", "body").mapInArrow(run, "h bigint, s bigint, j bigint, g bigint, r bigint")


def body_links(blocks: DataFrame, span: int) -> DataFrame:
    """``h, s, s2, j, j2, n``: windows ``j .. j + n - 1`` of body ``s`` are windows ``j2 ..`` of body ``s2``; each two bodies once.

    Bodies that several texts have are linked with themselves.  Equal windows within one body (it repeats
    itself) meet those of the other body in order, first with first, so a run of one sign is not squared.
    """
    distinct = blocks.groupBy("h", "s").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.min("body").alias("body"))
    zero = F.lit(0).cast("bigint")
    same = distinct.where("a <> z").select("h", "s", F.col("s").alias("s2"), zero.alias("j"), zero.alias("j2"), (F.char_length("body") - (span - 1)).cast("bigint").alias("n"))
    several = distinct.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    windows = body_windows(distinct.join(several, "h", "left_semi"), span)
    other = windows.select("h", "g", "r", F.col("s").alias("s2"), F.col("j").alias("j2"))
    met = windows.join(other, ["h", "g", "r"]).where("s < s2")
    runs = met.groupBy("h", "s", "s2", (F.col("j2") - F.col("j")).alias("shift")).agg(F.sort_array(F.collect_list("j")).alias("js"))
    whole = F.element_at("js", -1) - F.element_at("js", 1) + 1 == F.size("js")
    run = lambda j, n: F.struct(j.alias("j"), n.cast("bigint").alias("n"))
    stretches = F.when(whole, F.array(run(F.element_at("js", 1), F.size("js")))).otherwise(F.transform("js", lambda j: run(j, F.lit(1))))
    different = runs.withColumn("e", F.explode(stretches)).select("h", "s", "s2", "e.j", (F.col("e.j") + F.col("shift")).alias("j2"), "e.n")
    return same.unionByName(different)


def pair_matches(texts: DataFrame, span: int = 100, k: int = SEED) -> DataFrame:
    """``doc_id, partner_id, hits``: for every two texts that share a window, ``doc_id < partner_id``, all their matches ``(x, y, n)``
    of ``n`` windows, in no order."""
    blocks = reliable(shared_blocks(texts, span, k))
    own = blocks.select("h", "s", F.col("doc_id").alias("a"), F.col("at").alias("x"))
    other = blocks.select("h", F.col("s").alias("s2"), F.col("doc_id").alias("b"), F.col("at").alias("y"))
    met = body_links(blocks, span).join(own, ["h", "s"]).join(other, ["h", "s2"])
    met = met.where(F.when(F.col("s") == F.col("s2"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b")))
    x, y, turned = F.col("x") + F.col("j"), F.col("y") + F.col("j2"), F.col("a") > F.col("b")
    return (
        met.select(
            F.least("a", "b").alias("doc_id"), F.greatest("a", "b").alias("partner_id"),
            F.struct(F.when(turned, y).otherwise(x).alias("x"), F.when(turned, x).otherwise(y).alias("y"), "n").alias("hit"),
        )
        .groupBy("doc_id", "partner_id")
        .agg(F.collect_list("hit").alias("hits"))
    )


def pair_anchors(hits: list[dict], span: int) -> list[tuple[int, int, int]]:
    """Maximal matches ``(x, y, length)`` of two texts: windows on one diagonal that overlap or touch are one match."""
    runs: dict[int, list[tuple[int, int]]] = {}
    for hit in hits:
        runs.setdefault(hit["y"] - hit["x"], []).append((hit["x"], hit["x"] + hit["n"] - 1 + span))
    return [(lo, lo + shift, hi - lo) for shift, stretches in runs.items() for lo, hi in union(stretches)]


class PrefixMax:
    """Fenwick tree over ranks 0..n-1: the best ``(score, payload)`` among ranks up to a given one."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (n + 1)

    def put(self, rank: int, score: float, payload: int) -> None:
        i = rank + 1
        while i < len(self.best):
            if score > self.best[i][0]:
                self.best[i] = (score, payload)
            i += i & -i

    def upto(self, rank: int) -> tuple[float, int]:
        i, top = rank + 1, (float("-inf"), -1)
        while i > 0:
            if self.best[i][0] > top[0]:
                top = self.best[i]
            i -= i & -i
        return top


def chain(anchors: list[tuple[int, int, int]], gap_cost: float = GAP_COST) -> list[list[int]]:
    """Partition ``(x, y, length)`` matches of two texts into collinear chains of best score.

    A match may follow one that ends before it in both texts; the score is the matched length less
    ``gap_cost`` per code point skipped in either text.  The cost splits into a part of the earlier and a
    part of the later match, so the best predecessor is a prefix maximum over the ends in ``y`` among the
    matches that end before ``x``.  The best chain is taken whole, then the best of what is left, and so on.
    """
    if not anchors:
        return []
    ends = sorted({y + n for _, y, n in anchors})
    rank = {y: i for i, y in enumerate(ends)}
    tree = PrefixMax(len(ends))
    score = [0.0] * len(anchors)
    before = [-1] * len(anchors)
    events = sorted([(x, 1, i) for i, (x, _, _) in enumerate(anchors)] + [(x + n, 0, i) for i, (x, _, n) in enumerate(anchors)])
    import bisect

    for _, kind, i in events:  # at one x, matches that end are entered before matches that begin are scored
        x, y, n = anchors[i]
        if kind:
            value, j = tree.upto(bisect.bisect_right(ends, y) - 1) if ends[0] <= y else (float("-inf"), -1)
            gain = value - gap_cost * (x + y)
            score[i] = n + max(0.0, gain)
            before[i] = j if gain > 0 else -1
        else:
            tree.put(rank[y + n], score[i] + gap_cost * (x + n + y + n), i)
    taken = [False] * len(anchors)
    chains = []
    for i in sorted(range(len(anchors)), key=lambda i: -score[i]):
        members = []
        while i >= 0 and not taken[i]:
            taken[i] = True
            members.append(i)
            i = before[i]
        if members:
            chains.append(members[::-1])
    return chains


def union(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open stretches; overlapping or touching ones become one."""
    out: list[list[int]] = []
    for lo, hi in sorted(stretches):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _per_document(found: DataFrame, rows, schema: str, names: list[str], types: list[pa.DataType]) -> DataFrame:
    """Apply ``rows(doc_id, found) -> tuples`` to each document's matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out += rows(doc_id, blocks)
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

    return found.mapInArrow(run, schema)


def shared_stretches(documents: DataFrame, span: int = 100, k: int = SEED) -> DataFrame:
    """``doc_id, char_from, char_to``: stretches covered by passages of at least ``span`` code points that
    occur verbatim in another document.

    Overlapping or touching passages make one stretch.  A passage repeated only within one document, or in
    rows of one and the same ``doc_id``, is not shared.  Null, empty and shorter texts, and rows without an id,
    give no row; an empty table gives none.  Seeds and windows are compared by 64-bit hashes in pairs
    (seed and window), which stand for equality.  A ``span`` below 1 is an error.
    """

    def rows(doc_id: int, found: list[dict]) -> list[tuple]:
        windows = [(block["at"] + hit["j"], hit["n"]) for block in found for hit in block["hits"]]
        return [(doc_id, lo, hi) for lo, hi in union([(x, x + n - 1 + span) for x, n in windows])]

    return _per_document(
        matches(documents, span, k), rows, "doc_id bigint, char_from bigint, char_to bigint", ["doc_id", "char_from", "char_to"], [pa.int64()] * 3
    )


def shared_amounts(documents: DataFrame, span: int = 100, k: int = SEED) -> DataFrame:
    """Per document with an id: ``doc_id, n_chars, shared_chars, share`` (0 where nothing is shared or the text is null or empty)."""
    found = shared_stretches(documents, span, k).groupBy("doc_id").agg(F.sum(F.col("char_to") - F.col("char_from")).alias("shared_chars"))
    lengths = documents.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.coalesce(F.char_length("text"), F.lit(0))).cast("bigint").alias("n_chars"))
    shared = F.coalesce("shared_chars", F.lit(0)).cast("bigint")
    share = F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(F.lit(0.0))
    return lengths.join(found, "doc_id", "left").select("doc_id", "n_chars", shared.alias("shared_chars"), share.alias("share"))


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance of two gaps, exact at any length.

    A column of the table is kept as two bit strings, where it rises and where it falls by one from row to
    row (Myers; Hyyrö), so a step is a few operations on integers of as many bits as the shorter gap has code points.
    """
    if len(a) < len(b):
        a, b = b, a
    lead = _common(a, b)
    a, b = a[lead:], b[lead:]
    tail = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not b:
        return len(a)
    points = np.frombuffer(b.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    places = {ch: int.from_bytes(np.packbits(points == ord(ch), bitorder="little").tobytes(), "little") for ch in set(a) & set(b)}
    full, top = (1 << len(b)) - 1, len(b) - 1
    rise, fall, distance = full, 0, len(b)
    for ch in a:
        equal = places.get(ch, 0)
        level = equal | fall
        carried = (((equal & rise) + rise) ^ rise) | equal
        up = fall | (full & ~(carried | rise))
        down = rise & carried
        distance += (up >> top & 1) - (down >> top & 1)
        up = up << 1 | 1
        down <<= 1
        rise = full & (down | ~(level | up))
        fall = full & up & level
    return distance


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def distinct_texts(documents: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, text`` of each distinct text of at least ``span`` code points, under the least id that has it, and ``doc_id, copy_id, n``: its copies.

    Texts are compared by a 128-bit hash.  An id with several texts counts with the one of the greatest hash.
    """
    named = documents.where(F.col("doc_id").isNotNull() & (F.char_length("text") >= span)).select("doc_id", "text", F.unhex(F.md5("text")).alias("key"))
    keys = named.groupBy("doc_id").agg(F.max(F.struct("key", F.char_length("text").cast("bigint").alias("n"))).alias("k")).select("doc_id", "k.key", "k.n")
    firsts = keys.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("c"))
    copies = keys.join(firsts.where("c > 1"), "key").where("doc_id <> first").select(F.col("first").alias("doc_id"), F.col("doc_id").alias("copy_id"), "n")
    kept = firsts.select(F.col("first").alias("doc_id"), F.col("key").alias("own_key"))
    texts = named.join(kept, "doc_id").where("key = own_key").groupBy("doc_id").agg(F.min("text").alias("text"))
    return texts, copies


def fuzzy_passages(documents: DataFrame, span: int = 100, k: int = SEED, least: int | None = None) -> DataFrame:
    """Chains as passages, aligned: ``doc_id, char_from, char_to, partner_id, partner_from, partner_to, exact_chars, edits``.

    Every two different texts that share ``span`` code points are chained with each other, at all places, and
    give a row each way; only windows that one block repeats (a run of one sign, a short period) are matched in
    order, first with first, so the longer of two runs is left over.  Exact copies are one text, under the least id that has it: each copy has one row with
    that id, over the whole text, and that id one with each copy; what the text shares with others stands
    under that id alone, so rows follow the pairs of different texts and the number of documents.

    ``exact_chars`` lie in verbatim matches; ``edits`` is the edit distance of the gaps between them, whatever
    their length.  Passages shorter than ``least`` (default ``span``) are left out.
    """
    least = span if least is None else least
    texts, copies = distinct_texts(documents, span)
    names = ["doc_id", "char_from", "char_to", "partner_id", "partner_from", "partner_to", "exact_chars", "anchors"]
    types = [pa.int64()] * 7 + [pa.list_(pa.list_(pa.int64()))]
    schema = ", ".join(f"{n} bigint" for n in names[:-1]) + ", anchors array<array<bigint>>"

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, partner, hits in zip(*batch.columns, strict=True):
                anchors = pair_anchors(hits.as_py(), span)
                for members in chain(anchors):
                    own = [anchors[i] for i in members]
                    (x0, y0, _), (x1, y1, n1) = own[0], own[-1]
                    if max(x1 - x0, y1 - y0) + n1 >= least:
                        out.append((doc_id.as_py(), x0, x1 + n1, partner.as_py(), y0, y1 + n1, sum(a[2] for a in own), [list(a) for a in own]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    passages = pair_matches(texts, span, k).mapInArrow(chains, schema)
    cut = lambda frm, to: F.substring("text", F.col(frm) + 1, F.col(to) - F.col(frm))
    both = (
        passages.join(texts, "doc_id")
        .withColumn("own", cut("char_from", "char_to")).drop("text")
        .join(texts.withColumnRenamed("doc_id", "partner_id"), "partner_id")
        .withColumn("other", cut("partner_from", "partner_to")).drop("text")
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = []
            for row in batch.to_pylist():
                total = 0
                for (x, y, n), (u, v, _) in zip(row["anchors"], row["anchors"][1:], strict=False):
                    a = row["own"][x + n - row["char_from"] : u - row["char_from"]]
                    b = row["other"][y + n - row["partner_from"] : v - row["partner_from"]]
                    total += edit_distance(a, b)
                edits.append(total)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(edits, pa.int64())], names=[*names[:-1], "edits"])

    aligned = both.select(*names, "own", "other").mapInArrow(align, ", ".join(f"{n} bigint" for n in names[:-1]) + ", edits bigint")
    zero = F.lit(0).cast("bigint")
    whole = copies.select("doc_id", zero.alias("char_from"), F.col("n").alias("char_to"), F.col("copy_id").alias("partner_id"), zero.alias("partner_from"), F.col("n").alias("partner_to"), F.col("n").alias("exact_chars"), zero.alias("edits"))
    sides = ("doc_id", "partner_id"), ("char_from", "partner_from"), ("char_to", "partner_to")
    way = lambda turn: F.struct(*[F.col(n[turn]).alias(n[0]) for n in sides], *[F.col(n[1 - turn]).alias(n[1]) for n in sides], "exact_chars", "edits")
    rows = aligned.unionByName(whole).select(F.explode(F.array(way(0), way(1))).alias("row"))
    columns = [*names[:-1], "edits"]
    return rows.where(F.col("row.char_to") - F.col("row.char_from") >= least).select(*[f"row.{n}" for n in columns])
