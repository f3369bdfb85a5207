"""Language identification by compression.

Each language gets a raw-content zstandard dictionary, cut from a bounded sample of labelled
texts. A text goes to the language whose dictionary makes it smallest; where the two
smallest are too close the text is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from riskfeat.llm.common import Stages, distinct_counts, hash_share, plain

UNKNOWN = "und"
#: Bytes of a dictionary, and how many labelled texts are sampled for it at least.
DICTIONARY_BYTES = 48 * 1024
SAMPLE_TEXTS = 64
#: More languages than this are an error: the dictionaries go to every executor.
MAX_LANGUAGES = 512
#: A text is compressed in blocks so that dictionaries count through its whole length.
BLOCK_BYTES = 2048
#: Stands before each block: a block that shrinks anyway shows even a single match.
CARRIER = b" " * 64
SEARCH = {
    "window_log": 17,
    "chain_log": 16,
    "hash_log": 16,
    "search_log": 4,
    "min_match": 4,
    "target_length": 8,
    "strategy": zstandard.STRATEGY_GREEDY,
    "write_content_size": 0,
    "write_checksum": 0,
    "write_dict_id": 0,
}
#: Least share by which the best language must beat the second.
MARGIN = 0.004


def held_out(doc_id: Column, of: int = 5) -> Column:
    """Whether a document is kept from learning; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % of == 0, F.lit(False))


def excerpt(data: bytes, h: int, size: int) -> bytes:
    """``size`` bytes, cut to whole letters, of a text in UTF-8; its hash says from where."""
    at = h % (len(data) - size + 1) if size < len(data) else 0
    return data[at : at + size].decode("utf-8", "ignore").encode()


def portions(sizes: list[int], piece: int, budget: int) -> list[int]:
    """How many bytes each text gives: up to ``piece`` each in order until ``budget`` is out.

    What is left when the texts are out goes to those with more, in equal parts.
    """
    given = []
    for size in sizes:
        given.append(min(size, piece, max(0, budget - sum(given))))
    rest = budget - sum(given)
    more = sorted((size - g, i) for i, (size, g) in enumerate(zip(sizes, given)) if size > g)
    for k, (room, i) in enumerate(more):
        extra = min(room, rest // (len(more) - k))
        given[i] += extra
        rest -= extra
    return given


def _sample(stages: Stages, labelled: DataFrame, sample_texts: int, piece: int, budget: int) -> DataFrame:
    """(lang, h, text): different texts per language, the smallest by hash, enough for a dictionary.

    That is ``sample_texts``, and as many more as pieces of the language's mean size need; or all.
    """
    h = F.xxhash64("text")
    size = F.least(F.octet_length("text"), F.lit(piece)) + 1
    counts = distinct_counts(labelled, "lang", h, size, MAX_LANGUAGES)
    wanted = {r["lang"]: (r["n"], max(sample_texts, -(-budget * r["n"] // r["total"]))) for r in counts}
    sampled, times = None, 3
    # Chance may leave a language short of texts; it then gets a larger part of the hash range.
    while wanted:
        found = stages(
            hash_share(labelled, "lang", h, {g: times * w / n for g, (n, w) in wanted.items()})
            .groupBy("lang", h.alias("h"))
            .agg(F.min("text").alias("text")),
            f"sample-{times}",
        )
        got = {r["lang"]: r["count"] for r in found.groupBy("lang").count().collect()}
        wanted = {g: (n, w) for g, (n, w) in wanted.items() if got.get(g, 0) < min(n, w)}
        enough = found.where(~F.col("lang").isin(list(wanted))) if wanted else found
        sampled = enough if sampled is None else sampled.unionByName(enough)
        times *= 8
    return sampled


def learn_dictionaries(
    docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, dictionary_bytes: int = DICTIONARY_BYTES
) -> dict[str, bytes]:
    """One dictionary per ``lang`` from the documents with a text and a language.

    A fixed pseudo-random sample of different texts per language fills ``dictionary_bytes``: some
    ``sample_texts`` or more if they are short, or all that the language has. Each gives an equal part, in bytes,
    from a place in its whole length that its hash chooses; what short ones leave further ones fill,
    and at last longer ones. Only the sizes of the texts that fit and the dictionaries come to the driver.
    """
    piece = max(1, dictionary_bytes // sample_texts - 1)
    labelled = docs.where("lang IS NOT NULL AND length(text) > 0").select("lang", "text")
    sampled = _sample(Stages(docs.sparkSession, "language-id"), labelled, sample_texts, piece, dictionary_bytes)
    if sampled is None:
        return {}

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [len(plain(t).encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("h"), pa.array(found, pa.int64())], ["lang", "h", "size"]
            )

    # The place is by hash; one more byte stands between two pieces.
    by_hash = Window.partitionBy("lang").orderBy("h")
    taken = F.coalesce(
        F.sum(F.least(F.col("size"), F.lit(piece)) + 1).over(by_hash.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    lang_type = docs.schema["lang"].dataType.simpleString()
    fits = sampled.mapInArrow(sizes, f"lang {lang_type}, h long, size long").withColumn("taken", taken)
    texts = {}
    for r in fits.where(F.col("taken") < dictionary_bytes).orderBy("lang", "h").collect():
        texts.setdefault(r["lang"], []).append((r["h"], r["size"]))
    given = {
        (lang, h): n
        for lang, of in texts.items()
        for (h, _), n in zip(of, portions([size for _, size in of], piece, dictionary_bytes - len(of) + 1))
    }

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r["lang"], r["h"], r["text"]) for r in batch.to_pylist() if (r["lang"], r["h"]) in given]
            cut = [(lang, h, excerpt(plain(text).encode(), h, given[lang, h])) for lang, h, text in rows]
            columns = list(zip(*cut)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.binary()))], ["lang", "h", "piece"]
            )

    parts = {}
    for r in sampled.mapInArrow(pieces, f"lang {lang_type}, h long, piece binary").orderBy("lang", "h").collect():
        parts.setdefault(r["lang"], []).append(bytes(r["piece"]))
    return {lang: b" ".join(of)[:dictionary_bytes] for lang, of in parts.items()}


class Compressors:
    """One compressor per language."""

    letter = regex.compile(r"\p{L}")

    def __init__(self, dictionaries: dict[str, bytes]):
        self.languages = list(dictionaries)
        self.compressors = []
        search = zstandard.ZstdCompressionParameters(**SEARCH)
        for content in dictionaries.values():
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=search)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=shared, compression_params=search))

    def judge(self, text: str | None, margin: float) -> tuple[str, float, bool]:
        """(language, score, accepted). The score is how far ahead of the second the best is."""
        if not text or not self.languages or not self.letter.search(text):
            return UNKNOWN, 0.0, False
        data = plain(text).encode("utf-8", "replace")
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = sorted(
            (sum(len(c.compress(CARRIER + b)) for b in blocks), language)
            for language, c in zip(self.languages, self.compressors)
        )
        if len(sizes) == 1:
            return sizes[0][1], 1.0, True
        (best, language), (second, _) = sizes[:2]
        ahead = (second - best) / second
        return language, ahead, ahead >= margin


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """Adds ``lang_pred``, ``score`` (0 to 1) and ``accepted``, replacing such columns.

    The text alone decides, all of it. A null text, an empty one, or one without a letter is
    ``und`` with score 0 and not accepted, and so is every text if nothing was learned. Ties
    go to the language first by code point and are not accepted. One learned language
    takes every text with letters. Repeated rows get equal results; an empty table stays empty.
    """
    others = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    docs = docs.select(others)
    shipped = docs.sparkSession.sparkContext.broadcast(dictionaries)
    schema = StructType(
        [
            *docs.schema.fields,
            StructField("lang_pred", StringType()),
            StructField("score", DoubleType()),
            StructField("accepted", BooleanType()),
        ]
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(shipped.value)
        for batch in batches:
            found = [compressors.judge(t, margin) for t in batch.column("text").to_pylist()]
            columns = list(zip(*found)) or [[], [], []]
            out = pa.Table.from_batches([batch])
            for name, values, kind in zip(
                ("lang_pred", "score", "accepted"), columns, (pa.string(), pa.float64(), pa.bool_())
            ):
                out = out.append_column(name, pa.array(values, kind))
            yield from out.to_batches()

    return docs.mapInArrow(judged, schema)
