"""Language ID by prediction by partial matching: byte context trees with escapes, frozen after training."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import crc_mod, saved, table
from .textbytes import text_runs

#: Bits for a byte that no context knows, not even the empty one.
FLAT_BITS = 8.0
#: More languages than this are refused: their sizes are broadcast, and each text is coded in all of them.
MAX_LANGS = 1000
#: Bytes that the trees may take, which the driver puts together and each task holds: CELL for a string and language.
MAX_TREES, CELL = 200_000_000, 8


@dataclass
class ContextTrees:
    """The trees of all languages laid over each other, by depth.

    grams[d] are the byte strings of length d + 1 that some tree holds, packed big-endian and
    sorted. bits[d][g + 1] are, by language, the exact bits to code the last byte of gram g after
    the others (row 0 is for a gram that no tree holds). leave[d][g + 1] are the bits to escape from
    the context of length d that is gram g of grams[d - 1]; leave[0] has the empty context only.
    """

    langs: list[str]
    grams: list[np.ndarray]
    bits: list[np.ndarray]
    leave: list[np.ndarray]


def count_grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length 1 to depth: the strings inside texts, packed, and how often each occurs."""
    packed, out = np.zeros(len(data), np.uint64), []
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))  # bytes from here to the text's end
    for d in range(depth):
        last = np.zeros(len(data), np.uint64)
        last[: len(data) - d] = data[d:]
        packed = (packed << np.uint64(8)) | last
        out.append(np.unique(packed[room > d], return_counts=True))
    return out


def build_trees(counts: pd.DataFrame, langs: list[str], depth: int) -> ContextTrees:
    """counts: columns lang, depth (0-based), gram, n. Method C: a context with n symbols of t kinds escapes with t / (n + t)."""
    col = {x: i for i, x in enumerate(langs)}
    grams, bits, leave = [], [], []
    for d in range(depth):
        own = counts[counts["depth"] == d]
        keys, at = np.unique(own["gram"].to_numpy().astype(np.uint64), return_inverse=True)
        n = np.zeros((len(keys), len(langs)))
        np.add.at(n, (at, own["lang"].map(col).to_numpy(dtype=int)), own["n"].to_numpy(dtype=float))
        above = np.searchsorted(grams[d - 1], keys >> np.uint64(8)) + 1 if d else np.ones(len(keys), int)
        size = len(grams[d - 1]) + 1 if d else 2
        total, kinds = np.zeros((size, len(langs))), np.zeros((size, len(langs)))
        np.add.at(total, above, n)
        np.add.at(kinds, above, n > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
            coded = -np.log2(n / (total + kinds)[above])
        if d:
            shorter = keys & np.uint64((1 << 8 * d) - 1)
            fallback = bits[d - 1][np.searchsorted(grams[d - 1], shorter) + 1]
        else:
            fallback = np.full((len(keys), len(langs)), FLAT_BITS)
        grams.append(keys)
        bits.append(np.vstack([np.zeros(len(langs)), np.where(n > 0, coded, escape[above] + fallback)]))
        leave.append(escape)
    return ContextTrees(langs, grams, bits, leave)


class Coder:
    """Code lengths of texts under the trees, for many positions at once."""

    def __init__(self, trees: ContextTrees):
        self.trees = trees
        alphabet = trees.grams[0].astype(np.int64)
        self.width = len(alphabet) + 1
        self.code = np.full(256, len(alphabet), np.int32)
        self.code[alphabet] = np.arange(len(alphabet), dtype=np.int32)
        self.down = []
        for d in range(len(trees.grams)):
            keys = trees.grams[d]
            child = np.zeros(((len(trees.grams[d - 1]) + 1 if d else 1), self.width), np.int32)
            above = np.searchsorted(trees.grams[d - 1], keys >> np.uint64(8)) + 1 if d else np.zeros(len(keys), int)
            child[above, self.code[(keys & np.uint64(255)).astype(int)]] = np.arange(1, len(keys) + 1)
            self.down.append(child.reshape(-1))

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text by language."""
        n, depth = len(data), len(self.down)
        out = np.zeros((len(offsets) - 1, len(self.trees.langs)))
        if not n:
            return out
        code = self.code[data]
        nodes = [self.down[0][code]]  # nodes[d][i]: the string of length d + 1 that begins at i
        for d in range(1, depth):
            step = np.zeros(n, np.int32)
            if n > d:
                step[: n - d] = self.down[d][nodes[-1][: n - d] * self.width + code[d:]]
            nodes.append(step)
        before = np.arange(n, dtype=np.int64) - np.repeat(offsets[:-1], np.diff(offsets))  # bytes of the text before here
        cost = np.zeros((n, out.shape[1]))
        todo = np.arange(n)
        for d in range(depth - 1, -1, -1):
            can = todo[before[todo] >= d] if d else todo
            node = nodes[d][can - d]
            hit = node > 0
            cost[can[hit]] += self.trees.bits[d][node[hit]]
            miss = can[~hit]
            context = nodes[d - 1][miss - d] if d else np.ones(len(miss), int)
            cost[miss] += self.trees.leave[d][context]
            todo = np.sort(np.concatenate((miss, todo[before[todo] < d]))) if d else miss
        cost[todo] += FLAT_BITS
        some = np.flatnonzero(np.diff(offsets))
        out[some] = np.add.reduceat(cost, offsets[some], axis=0)
        return out


def fit_languages(
    docs: DataFrame, depth: int = 5, train_docs: int = 1500, train_chars: int = 20_000, min_deep: int = 2,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> ContextTrees:
    """Trees from docs with text and lang; the trees are bounded as their sample is.

    The sample is, for each language, about train_docs documents by a hash of the id; of a text of over train_chars characters it takes a run of
    so many from a place that the hash picks, so that a language whose texts are all long is learned as others are. Each language that has a text that is
    not empty is learned. Strings of over three bytes must occur min_deep times; shorter ones all stay, so no language loses its own. Many languages
    need a smaller sample: trees beyond MAX_TREES bytes stop the fit with figures before anything is gathered.
    """
    rows = docs.filter(F.col(lang_col).isNotNull() & (F.length(F.col(text_col)) > 0))
    sizes = rows.groupBy(F.col(lang_col).alias("_lang")).agg(F.count(F.lit(1)).alias("_n"))
    if sizes.count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    draw = lambda salt: F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    spare = F.greatest(F.length(text_col) - train_chars, F.lit(0))
    part = F.substring(F.col(text_col), (1 + F.floor(draw(8) * (spare + 1))).cast("int"), F.lit(train_chars))
    chosen = rows.select(F.col(lang_col).alias("_lang"), draw(7).alias("_u"), F.lower(part).alias("_text"))
    chosen = chosen.join(F.broadcast(sizes), "_lang").filter(F.col("_u") * F.col("_n") < train_docs).select("_lang", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            for lang in sorted(set(langs)):
                own = pa.array(np.asarray(batch.column(1).to_pylist(), object)[langs == lang], pa.string())
                for _, _, data, offsets in text_runs(own, 1 << 24):
                    for d, (gram, n) in enumerate(count_grams(data, offsets, depth)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), d, np.int32)), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))],
                            names=["lang", "depth", "gram", "n"],
                        )

    counted = saved(chosen.mapInArrow(count, "lang string, depth int, gram long, n long").groupBy("lang", "depth", "gram").agg(F.sum("n").alias("n")))
    kept = counted.groupBy("depth", "gram").agg(F.sum("n").alias("_all")).filter((F.col("depth") < 3) | (F.col("_all") >= min_deep))
    langs, strings = sorted(r["lang"] for r in counted.select("lang").distinct().collect()), kept.count()
    if strings * max(len(langs), 1) * CELL > MAX_TREES:
        raise ValueError(
            f"{strings} strings of {len(langs)} languages take {strings * len(langs) * CELL} bytes, over {MAX_TREES}: a smaller sample (train_docs, train_chars), or min_deep"
        )
    return build_trees(counted.join(kept.drop("_all"), ["depth", "gram"], "left_semi").toPandas(), langs, depth)


def identify(docs: DataFrame, trees: ContextTrees, text_col: str = "text", name: str = "_language") -> DataFrame:
    """docs with name: struct<lang, score, bits>, from the text alone.

    lang codes the text in the fewest bits, score is its share of the likelihood of all
    languages. A null text, one without a letter, or any text when no language was learned gives
    ("und", 0, null). Ties go to the language first by name. Whole texts of any length are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("bits", pa.float64())])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = None
        for texts in batches:
            coder = coder or Coder(shared.value)
            names, scores, best = [], [], []
            for _, _, data, offsets in text_runs(texts, 1 << 21):
                bits = coder.lengths(data, offsets)
                first = bits.argmin(axis=1)
                low = bits.min(axis=1)
                scores.append(1 / np.exp2(np.clip(low[:, None] - bits, -1000, 0)).sum(axis=1))
                names.append(np.array(coder.trees.langs, object)[first])
                best.append(low)
            if not names:
                yield pa.array([], kind)
                continue
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(names), pa.string()), pa.array(np.concatenate(scores)), pa.array(np.concatenate(best))], fields=list(kind)
            )

    text = F.col(text_col).cast("string")
    none = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"))
    if not trees.langs:
        return docs.withColumn(name, none)
    coded = F.arrow_udf(run, "lang string, score double, bits double")(F.lower(text))
    return docs.withColumn(name, F.when(F.coalesce(text.rlike(r"\p{L}"), F.lit(False)), coded).otherwise(none))


def op2_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = fit_languages(docs.filter(crc_mod("doc_id", 5) != 0))
    got = identify(docs.select("doc_id", "text"), trees)
    return got.select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), F.col("_language.lang").alias("lang_pred"),
        F.col("_language.score").alias("score"), F.col("_language.bits").alias("code_bits"),
    )
