"""MinHash near-duplicate groups: many minima, bands, verification, and components.

Texts with equal shingle sets are one class; only one text of each class takes part
in the search. Classes that share a band key are candidates. Not all pairs of a band
bucket are looked at: first each member meets the bucket's smallest member; then,
in buckets that still hold several components, each member meets its best partner in
another component by signature; last, the pairs across components that are left.
Candidates whose signatures agree enough are confirmed on full sets. Where a member
has very many of them left, the families it belongs to meet block by block instead,
and only confirmed links leave the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareway.llm.common import NO_ID, WordCodes, distinct, id_and_text, key, map_rows, shingles, ship, small_batches, unkey, unused
from fareway.session import materialize

BANDS, ROWS = 32, 5
_MINIMA = BANDS * ROWS
#: Signatures of a bucket, and texts of a family, in one half of a block pair.
_SIGNATURES, _TEXTS = 2048, 256
#: Candidates of a member in a block pair that are confirmed one by one; beyond, its families meet in blocks.
_FEW = 32
_rng = np.random.default_rng(20240801)
_A = (_rng.integers(0, 2**63, _MINIMA, dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _rng.integers(0, 2**63, _MINIMA, dtype=np.int64).astype(np.uint64)


def _words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _set(codes: WordCodes, text: str, n: int) -> np.ndarray:
    return distinct(shingles(codes.of(_words(text)), n))


def minima(codes: np.ndarray) -> np.ndarray:
    """Smallest value of each universal hash a * x + b (mod 2^64, upper half) over a shingle set."""
    out = np.full(_MINIMA, 2**64 - 1, np.uint64)
    for i in range(0, len(codes), 256):
        part = codes[i : i + 256]
        np.minimum(out, (_A[:, None] * part[None, :] + _B[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, content (128-bit hash of the shingle set), bands and sig (a byte a minimum)."""

    def run(batches):
        codes = WordCodes()
        for batch in batches:
            sizes, contents, bands, sigs = [], [], [], []
            for text in batch["text"]:
                own = _set(codes, text.as_py(), n)
                sizes.append(len(own))
                contents.append(xxhash.xxh3_128_digest(own.tobytes()))
                if not len(own):
                    bands.append(None), sigs.append(None)
                    continue
                found = minima(own)
                bands.append([xxhash.xxh3_64_intdigest(row.tobytes(), seed=b) - 2**63 for b, row in enumerate(found.reshape(BANDS, ROWS))])
                sigs.append((found & np.uint32(255)).astype(np.uint8).tobytes())
            yield {"doc_id": batch["doc_id"], "n_shingles": sizes, "content": contents, "bands": bands, "sig": sigs}

    small_batches(docs.sparkSession)
    return map_rows(id_and_text(docs), "doc_id long, n_shingles long, content binary, bands array<long>, sig binary", run)


def _agreement(threshold: float) -> float:
    """Least share of equal signature bytes of a pair at the threshold, but for one in a million."""
    return threshold - 5 * (threshold * (1 - threshold) / _MINIMA) ** 0.5


def _best(pairs: DataFrame) -> DataFrame:
    """Of pairs u, v, agree: each u with the v it agrees with most."""
    best = pairs.groupBy("u").agg(F.max(F.struct("agree", (-F.col("v")).alias("w"))).alias("best"))
    return best.select("u", (-F.col("best.w")).alias("v"))


def _agreeing(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures agree in a share of ``least`` or more, with that share."""
    joined = pairs.join(sigs.select(F.col("node").alias("u"), F.col("sig").alias("su")), "u").join(
        sigs.select(F.col("node").alias("v"), F.col("sig").alias("sv")), "v"
    )

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            su, sv = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, _MINIMA) for c in ("su", "sv"))
            agree = (su == sv).mean(1)
            keep = agree >= least
            yield {"u": np.asarray(batch["u"])[keep], "v": np.asarray(batch["v"])[keep], "agree": agree[keep]}

    return map_rows(joined, "u long, v long, agree double", run)


def _deal(members: DataFrame, group: str, block: int) -> DataFrame:
    """Rows of each group in blocks i <= j, so that any two rows of a group meet in one block pair; own is a row's block."""
    sizes = members.groupBy(group).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    dealt = members.join(sizes, group).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("parts", "other")


def _mixed(buckets: DataFrame, placed: DataFrame) -> DataFrame:
    """Members, with their components, of the buckets that hold several components."""
    rows = buckets.join(placed, "node")
    mixed = rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return rows.join(mixed.select("band"), "band", "left_semi")


def _across(blocks: DataFrame, least: float, best: bool) -> DataFrame:
    """u, v, agree of members of different components whose signatures agree.

    With ``best`` one pair for each member of a block pair. Else all, but for members
    with more than ``_FEW``: those give one row with the band and no v.
    """

    def run(block: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        node, component, own = (np.asarray(t[c]) for c in ("node", "component", "own"))
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(-1, _MINIMA)
        band, i, j = (x.as_py() for x in block)
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        us, vs, shares, bands = [], [], [], []
        for some, others in ((left, right), (right, left))[: 2 if best else 1]:
            for k in some if len(others) else ():
                agree = (sig[others] == sig[k]).mean(1)
                agree[component[others] == component[k]] = -1
                hits = np.array([agree.argmax()]) if best else np.arange(len(others))
                hits = hits[agree[hits] >= least]
                if not best and len(hits) > _FEW:
                    us.append(int(node[k])), vs.append(None), shares.append(1.0), bands.append(band)
                    continue
                us += [int(node[k])] * len(hits)
                vs += node[others[hits]].tolist()
                shares += agree[hits].tolist()
                bands += [None] * len(hits)
        kinds = {"u": (us, pa.int64()), "v": (vs, pa.int64()), "agree": (shares, pa.float64()), "band": (bands, pa.int64())}
        return pa.table({name: pa.array(values, kind) for name, (values, kind) in kinds.items()})

    ship(blocks.sparkSession)
    return blocks.groupBy("band", "i", "j").applyInArrow(run, "u long, v long, agree double, band long")


def _within_families(members: DataFrame, texts: DataFrame, n: int, numerator: int, denominator: int) -> DataFrame:
    """Confirmed links between components of each family (family, node, component); one for two components in a block pair."""
    blocks = _deal(members.join(texts, "node"), "family", _TEXTS)

    def run(block: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        node, component, own = (np.asarray(t[c]) for c in ("node", "component", "own"))
        codes = WordCodes()
        sets = [_set(codes, text.as_py(), n) for text in t["text"]]
        sizes = np.array([len(x) for x in sets])
        left, right = np.flatnonzero(own == block[1].as_py()), np.flatnonzero(own == block[2].as_py())
        us, vs, seen = [], [], set()
        others = np.concatenate([sets[k] for k in right]) if len(right) else np.zeros(0, np.uint64)
        starts = np.r_[0, np.cumsum(sizes[right])[:-1]].astype(np.int64)
        for k in left if len(others) else ():
            at = np.minimum(np.searchsorted(sets[k], others), sizes[k] - 1)
            both = np.add.reduceat(sets[k][at] == others, starts)
            linked = denominator * both >= numerator * (sizes[k] + sizes[right] - both)
            for m in right[linked & (component[right] != component[k])]:
                two = (min(component[k], component[m]), max(component[k], component[m]))
                if two not in seen:
                    seen.add(two)
                    us.append(int(node[k])), vs.append(int(node[m]))
        return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    ship(blocks.sparkSession)
    return blocks.groupBy("family", "i", "j").applyInArrow(run, "u long, v long")


def _linked(a: np.ndarray, b: np.ndarray, numerator: int, denominator: int) -> bool:
    # an empty set is linked with nothing
    if not len(a) or not len(b) or denominator * min(len(a), len(b)) < numerator * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return denominator * both >= numerator * (len(a) + len(b) - both)


def confirm(pairs: DataFrame, texts: DataFrame, n: int, numerator: int, denominator: int) -> DataFrame:
    """Pairs u, v whose full sets hold: denominator * intersection >= numerator * union. The texts of all v stream past u's."""
    pairs = pairs.select("u", "v").distinct()
    heads = pairs.select("u", F.col("u").alias("node"), F.lit(True).alias("head")).distinct()
    rows = heads.unionByName(pairs.select("u", F.col("v").alias("node"), F.lit(False).alias("head")))
    rows = rows.join(texts, "node").repartition("u").sortWithinPartitions("u", F.desc("head"), "node")

    def run(batches):
        codes, at, own = WordCodes(), None, []
        for batch in batches:
            us, vs = [], []
            for u, head, node, text in zip(*(batch[c].to_pylist() for c in ("u", "head", "node", "text")), strict=True):
                mine = _set(codes, text, n)
                if head:
                    own = [*own, mine] if at == u else [mine]
                    at = u
                elif at == u and any(_linked(mine, other, numerator, denominator) for other in own):
                    us.append(u), vs.append(node)
            yield {"u": us, "v": vs}

    small_batches(rows.sparkSession)
    return map_rows(rows, "u long, v long", run)


def _settled(links: DataFrame) -> bool:
    """Whether distinct ``links`` are stars: each u names one v, and no v is a u."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("named")), F.struct(F.col("v").alias("node"), F.lit(0).alias("named"))
    )).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("named").alias("named"), F.count("*").alias("links"))
    return nodes.filter("named > 0 AND links > 1").agg(F.count("*")).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """node and component (smallest node reachable) of every node that ``edges`` (u, v) names.

    Alternating large-star and small-star: every node links its larger neighbours, then
    its smaller ones, to the smallest it sees, until only stars are left. Each round is
    written to the shared folder, so a lost executor costs one round at most.
    """
    links = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    while not _settled(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        large = both.join(low, "u").filter("v > u AND v <> low").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct(F.col("u").alias("u"), F.col("low").alias("v"))
        )).alias("e")).select("e.*").filter("u <> v").distinct()
        links = materialize(small, "links")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _merged(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` (node, component) after ``links`` (u, v) between its nodes; only links between components are followed."""
    ends = links.select("u", "v")
    for end in ("u", "v"):
        at = placed.select(F.col("node").alias(end), F.col("component").alias(f"{end}_at"))
        ends = ends.join(at, end)
    found = components(ends.select(F.col("u_at").alias("u"), F.col("v_at").alias("v")))
    found = found.select(F.col("node").alias("component"), F.col("component").alias("lower"))
    after = placed.join(found, "component", "left").select("node", F.coalesce("lower", "component").alias("component"))
    return materialize(after, "placed")


def near_duplicates(docs: DataFrame, n: int = 5, numerator: int = 80, denominator: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    A-Z are lower-cased; words are runs of anything but white space. A set holds the
    distinct ``n``-word shingles, the whole sequence if it is shorter. Texts link when
    denominator * intersection >= numerator * union; component_id is the smallest doc_id
    reachable, kept tells whether it is the row's own. A pair at the threshold itself
    shares no band with probability 3e-6; every link is confirmed on full sets.

    Null and empty texts have an empty set and link with nothing. Rows that share an id
    are one node: linked with whatever any of them links with. Null ids stay null and
    stand for one smallest id. An empty table gives no rows; other columns are not read.
    """
    least = _agreement(numerator / denominator)
    rows = materialize(signatures(docs, n), "signatures")
    own = rows.filter("n_shingles > 0").select("content", "doc_id").distinct()
    classes = materialize(own.groupBy("content").agg(F.min("doc_id").alias("node")), "classes")
    alike = own.join(classes, "content").filter("doc_id <> node").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    first = classes.select(F.col("node").alias("doc_id"), F.col("content").alias("class"))
    chosen = rows.join(first, "doc_id").filter("content = class").select(F.col("doc_id").alias("node"), "sig", "bands")
    sigs = chosen.select("node", "sig")

    members = chosen.select("node", F.explode("bands").alias("band"))
    hubs = members.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    buckets = materialize(members.join(hubs.select("band", "hub"), "band"), "buckets")
    nodes = materialize(buckets.select("node").distinct(), "nodes")
    # only texts that share a band with another are read again
    texts = materialize(id_and_text(docs).withColumnRenamed("doc_id", "node").join(nodes, "node", "left_semi"), "texts")
    stars = buckets.filter("node > hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    links = confirm(_best(_agreeing(stars, sigs, least)), texts, n, numerator, denominator)
    found = components(links)
    now = nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    now = materialize(now, "placed")

    blocks = _deal(_mixed(buckets.select("node", "band"), now).join(sigs, "node"), "band", _SIGNATURES)
    now = _merged(now, confirm(_best(_across(blocks, least, best=True)), texts, n, numerator, denominator))

    blocks = _deal(_mixed(buckets.select("node", "band"), now).join(sigs, "node"), "band", _SIGNATURES)
    left = materialize(_across(blocks, least, best=False).distinct(), "left")
    links = confirm(left.filter("v IS NOT NULL"), texts, n, numerator, denominator)
    crowds = left.filter("v IS NULL").select("band").distinct()
    if crowds.count():
        crowded = buckets.join(crowds, "band", "left_semi")
        families = components(crowded.select(F.col("node").alias("u"), F.col("hub").alias("v")))
        families = families.withColumnRenamed("component", "family").join(now, "node")
        links = links.unionByName(_within_families(families, texts, n, numerator, denominator))
    now = _merged(now, links)
    copies = alike.join(now, alike.v == now.node, "left").select("u", F.coalesce("component", "v").alias("v"))
    found = components(copies.unionByName(now.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))))
    return rows.select("doc_id", "n_shingles").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        unkey().alias("doc_id"), "n_shingles",
        F.nullif(F.coalesce("component", "doc_id"), F.lit(NO_ID)).alias("component_id"),
        (F.coalesce("component", "doc_id") == F.col("doc_id")).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one of the smallest id, then of the smallest text hash.

    A row is known by its id and the hash of its text, so rows that share an id are judged
    apart, and of rows equal in both one stays: the first in the order of all columns. Null
    and empty texts are near duplicates of nothing else; rows without id come before all
    others. All columns pass through, whatever their names; an empty table stays empty.
    """
    node = F.xxhash64(key(), F.coalesce("text", F.lit("")))
    nodes = materialize(docs.select(key().alias("id"), node.alias("node")).groupBy("id", "node").agg(F.count("*").alias("rows")), "rows")
    found = near_duplicates(docs.select(node.alias("doc_id"), "text"), **how).select(F.col("doc_id").alias("node"), "component_id").distinct()
    placed = materialize(nodes.join(found, "node"), "components")
    first = placed.groupBy("component_id").agg(F.min(F.struct("id", "node")).alias("first")).select("first.node")
    gone = placed.join(first, "node", "left_anti").select(F.col("node").alias(unused(docs, "gone")))
    left = docs.join(gone, node == F.col(gone.columns[0]), "left_anti")
    repeated = nodes.filter("rows > 1").select(F.col("node").alias(unused(docs, "again")))
    if repeated.isEmpty():
        return left
    same = node == F.col(repeated.columns[0])
    row = unused(docs, "row")
    names = [F.col(f"`{c}`") for c in docs.columns]
    chosen = left.join(repeated, same, "left_semi").groupBy(node.alias(repeated.columns[0])).agg(F.min(F.struct(*names)).alias(row))
    return left.join(repeated, same, "left_anti").unionByName(chosen.select(f"{row}.*"))
