"""Languages of texts by n-gram filters: each slot of a Bloom filter holds a bit for every language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.shared import cut, remainder_of_id, table, text_batches

N = 3
#: Slots of the filter by n-gram kept, and probes of each n-gram.
SLOTS_PER_GRAM, PROBES = 16, 2
#: Most bytes of the filter, which is sent to every task. A slot takes 8 bytes for each 64 languages. More n-grams
#: or languages fill it more, which the correction for false positives takes into account.
MOST_BYTES = 32 << 20
#: Slots that one task puts together.
BLOCK_SLOTS = 1 << 12
#: A language contains an n-gram if its share there is this part of its share in the language that uses it most.
LEAST_PART = 0.2
LANGUAGES_A_MASK = 64
UNKNOWN = "und"
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def grams_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the character n-grams of all texts and the text of each.

    Letters in lower case; whatever is no letter, a text's end included, counts as one blank. N-grams with a
    letter in the middle only. A key is the code points side by side, 21 bits each, so that keys do not clash.
    """
    joined = " " + " ".join([(t or b"").decode().lower().replace("\x00", " ") + "\x00" for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(codes) < N:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    owner = np.cumsum(codes == 0)  # lower case may be longer than the text, so ends are marked
    letter = ((codes >= 97) & (codes <= 122)) | (codes >= 192)
    codes = np.where(letter, codes, np.uint64(32))
    keys = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    inner = letter[1:-1]
    return keys[inner], owner[1:-1][inner]


def _slots(keys: np.ndarray, size: int) -> list[np.ndarray]:
    """Two hashes make all probes."""
    mixed = keys * _ODD[0]
    mixed ^= mixed >> np.uint64(29)
    one, two = mixed * _ODD[1], (mixed * _ODD[2]) | np.uint64(1)
    return [((one + np.uint64(i) * two) >> np.uint64(24)) % np.uint64(size) for i in range(PROBES)]


def _slots_for(grams: int, languages: int, most_bytes: int = MOST_BYTES) -> int:
    """Slots of a filter: a power of two, enough for the n-grams if the bytes allow it."""
    columns = max(1, -(-languages // LANGUAGES_A_MASK))
    return 1 << min((most_bytes // (8 * columns)).bit_length() - 1, (SLOTS_PER_GRAM * max(1, grams) - 1).bit_length())


class GramFilter:
    """Looks up the languages of n-grams; made from the n-grams of each language, or by `of_masks` from ready masks.

    masks[c] has a mask a slot for the languages from 64 c on.
    """

    def __init__(self, languages: list[str], grams: list[np.ndarray]):
        size = _slots_for(sum(map(len, grams)), len(languages))
        masks = np.zeros((max(1, -(-len(languages) // LANGUAGES_A_MASK)), size), np.uint64)
        for i, keys in enumerate(grams):
            for slots in _slots(keys, size):
                masks[i // LANGUAGES_A_MASK, slots] |= np.uint64(1 << i % LANGUAGES_A_MASK)
        self._set(languages, masks)

    def _set(self, languages: list[str], masks: np.ndarray) -> None:
        self.languages, self.masks, self.size = languages, masks, masks.shape[1]
        # How often an n-gram foreign to a language is found there all the same.
        filled = np.array([np.mean(self._bit(masks[i // LANGUAGES_A_MASK], i)) for i in range(len(languages))])
        self.false = filled ** PROBES

    @classmethod
    def of_masks(cls, languages: list[str], masks: np.ndarray) -> GramFilter:
        made = cls.__new__(cls)
        made._set(languages, masks)
        return made

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return masks >> np.uint64(i % LANGUAGES_A_MASK) & np.uint64(1)

    def languages_of(self, keys: np.ndarray, column: int = 0) -> np.ndarray:
        """Masks of the languages from 64 * column on that contain each n-gram."""
        slots = _slots(keys, self.size)
        out = self.masks[column, slots[0]]
        for more in slots[1:]:
            out = out & self.masks[column, more]
        return out

    def counts(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """N-grams of each text, and how many of them each language contains, without false positives on average."""
        keys, owner = grams_of(texts)
        total = np.bincount(owner, minlength=len(texts))[:len(texts)].astype(float)
        hits = np.zeros((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            if i % LANGUAGES_A_MASK == 0:
                found = self.languages_of(keys, i // LANGUAGES_A_MASK)
            hits[:, i] = np.bincount(owner, weights=self._bit(found, i).astype(float), minlength=len(texts))[:len(texts)]
        return total, np.clip((hits - self.false * total[:, None]) / (1 - np.minimum(self.false, 0.999)), 0, total[:, None])


def _masks_of(kept: DataFrame, size: int, columns: int) -> np.ndarray:
    """The masks of all slots from rows of an n-gram and the numbers of its languages, put together by the tasks.

    The driver gets `columns` * `size` masks as bytes, however many n-grams there are.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1)
            at = pa.compute.list_parent_indices(langs).to_numpy(zero_copy_only=False)
            lang = langs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)[at]
            mask = np.left_shift(np.uint64(1), (lang % LANGUAGES_A_MASK).astype(np.uint64)).view(np.int64)
            for slots in _slots(keys, size):
                cell = slots.astype(np.int64) + size * (lang // LANGUAGES_A_MASK)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(mask)], ["cell", "mask"])

    def joined(rows: pa.Table) -> pa.Table:
        cells, block = rows.column("cell").to_numpy(), rows.column("block")[0].as_py()
        part = np.zeros(BLOCK_SLOTS, np.int64)
        part[cells - block * BLOCK_SLOTS] = rows.column("mask").to_numpy()
        return pa.table({"block": pa.array([block], pa.int64()), "part": pa.array([part.tobytes()], pa.binary())})

    cells = kept.mapInArrow(bits, "cell long, mask long").groupBy("cell").agg(F.bit_or("mask").alias("mask"))
    blocks = cells.withColumn("block", F.floor(F.col("cell") / BLOCK_SLOTS)).groupBy("block").applyInArrow(joined, "block long, part binary")
    masks = np.zeros(-(-columns * size // BLOCK_SLOTS) * BLOCK_SLOTS, np.uint64)
    for r in blocks.collect():
        masks[r.block * BLOCK_SLOTS:(r.block + 1) * BLOCK_SLOTS] = np.frombuffer(r.part, np.uint64)
    return masks[:columns * size].reshape(columns, size)


def learned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_bytes: int = MOST_BYTES) -> GramFilter:
    """The filter of all rows with a language: every n-gram and every language counts.

    N-grams are counted, and the filter is put together, in the tasks. What comes to the driver are the names of the
    languages and the filter itself, whose bytes are bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            names = np.array(batch.column(1).to_pylist(), object)
            for name in dict.fromkeys(names):
                keys, n = np.unique(grams_of([t for t, l in zip(texts, names) if l == name])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sums = cut(rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = sums.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").collect()
    languages = [r.lang for r in totals]
    numbered = docs.sparkSession.createDataFrame([(i, r.lang, r.total) for i, r in enumerate(totals)], "number int, lang string, total long")
    # One row a language: these are the names that the driver has anyway.
    shares = sums.join(F.broadcast(numbered), "lang").select("gram", "number", (F.col("n") / F.col("total")).alias("share"))
    best = shares.groupBy("gram").agg(F.max("share").alias("best"), F.collect_list(F.struct("number", "share")).alias("by"))
    kept = cut(best.select("gram", F.expr(f"transform(filter(by, x -> x.share >= {LEAST_PART} * best), x -> x.number)").alias("langs")))
    size = _slots_for(kept.agg(F.sum(F.size("langs"))).first()[0] or 0, len(languages), most_bytes)
    return GramFilter.of_masks(languages, _masks_of(kept, size, max(1, -(-len(languages) // LANGUAGES_A_MASK))))


def predicted(docs: DataFrame, model: GramFilter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score, n_grams.

    The language that contains most of a text's n-grams; of equals the first by name. The score is the share of
    n-grams it contains, less half that of the next, scaled to 0..1. `und` with score 0 for a text that is null
    or has no letter, and for any text if no language was learned. Repeated rows and null ids keep one result
    each; whole texts of any length count; other columns are ignored; an empty table gives an empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            known = sent.value
            total, hits = known.counts(texts)
            has = np.array([any(map(str.isalpha, (t or b"").decode())) for t in texts], bool)
            shares = np.concatenate([hits / np.maximum(total, 1)[:, None], np.zeros((len(texts), 1))], axis=1)
            first = shares.argmax(axis=1)
            top = np.sort(shares, axis=1)[:, ::-1]
            score = np.clip(top[:, 0] - (0.5 * top[:, 1] if shares.shape[1] > 1 else 0), 0, 1)
            names = [known.languages[i] if ok and known.languages else UNKNOWN for i, ok in zip(np.minimum(first, max(0, len(known.languages) - 1)), has)]
            score = [float(s) if n != UNKNOWN else 0.0 for s, n in zip(score, names)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(total.astype(np.int64))], ["doc_id", "lang_pred", "score", "n_grams"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, n_grams long")


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = learned(docs.where(remainder_of_id("doc_id", 3) != 1))
    return predicted(docs, model).select("doc_id", (remainder_of_id("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "n_grams")
