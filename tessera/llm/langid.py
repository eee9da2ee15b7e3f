"""Language ID by compression: a text belongs to the language whose dictionary shrinks it most.

Each language gets a zstandard raw-content dictionary made of the commonest words of a bounded
sample of its training documents, the commonest last (nearest to the text). A text, folded to
lower-case letters, is cut into pieces of ``PIECE`` bytes (the whole text, piece by piece), each
piece is compressed with every dictionary, and the smallest total wins. A text whose best and second
best totals are nearly equal is *rejected*.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import give_back, privately

PIECE = 2000
_NOT_WORD = re.compile(r"[\W\d_]+")


def fold(text: str | None) -> str:
    """Lower-case letters, other runs as one space."""
    out = _NOT_WORD.sub(" ", text.lower()).strip() if text else ""
    if out and not out.replace(" ", "").isalpha():
        # Python counts some numerals (½ ² ① Ⅷ) as characters of words; they are no letters.
        out = " ".join("".join([c if c.isalpha() else " " for c in out]).split())
    return out


def language_dictionaries(train: DataFrame, docs_per_language: int = 600, dict_bytes: int = 8000,
                          lang: str = "lang", text: str = "text", key: str = "doc_id") -> dict[str, bytes]:
    """{language: dictionary} from ``train``; rows of null text or language take no part.

    At most ``docs_per_language`` documents of each language are looked at, those with the smallest
    key hashes (ties at the last hash all count), and ``dict_bytes`` bounds each dictionary.
    """
    rows = (train.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
            .select(F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h"), F.col(text).alias("text")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    cut = (rows.select("lang", "h").withColumn("r", rank).where(F.col("r") <= docs_per_language)
           .groupBy("lang").agg(F.max("h").alias("cut")).collect())
    if not cut:
        return {}
    picked = None
    for r in cut:  # one clause for each language
        clause = (F.col("lang") == r["lang"]) & (F.col("h") <= r["cut"])
        picked = clause if picked is None else picked | clause
    folded = F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " ")
    counts = (rows.where(picked).select("lang", F.explode(F.array_distinct(F.split(folded, " "))).alias("w"))
              .where("w <> ''").groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "w")
    size = F.sum(F.octet_length("w") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0))
    top = counts.withColumn("bytes", size).where(F.col("bytes") <= dict_bytes).select("lang", "w", "n").collect()
    words: dict[str, list] = {r["lang"]: [] for r in cut}
    for r in top:
        words[r["lang"]].append((r["n"], r["w"]))
    return {k: (" ".join(w for _, w in sorted(v)) + " ").encode() for k, v in sorted(words.items()) if v}


def predict(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = 0.002, level: int = 5,
            text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score (0 to 1), rejected.

    A null text, or one without a letter, is ``und``, score 0, rejected; so is any text when there
    is no dictionary. Otherwise the smallest total wins (a tie goes to the first language by code
    point). ``rejected`` marks a best total within ``margin`` of the second, as a share.
    """
    names = list(dictionaries)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", lang_pred string, score double, rejected boolean"
    keep = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as z

        def coder(raw: bytes):
            p = z.ZstdCompressionParameters.from_level(
                level, source_size=PIECE, dict_size=len(raw), write_content_size=0, write_dict_id=0)
            return z.ZstdCompressor(compression_params=p, dict_data=z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT))

        coders = [coder(dictionaries[n]) for n in names]
        for batch in batches:
            preds, scores, rejects = [], [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                data = fold(value.as_py()).encode()
                if not data or not names:
                    preds.append("und"), scores.append(0.0), rejects.append(True)
                    continue
                pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
                total = [sum(len(c.compress(p)) for p in pieces) for c in coders]
                best = min(range(len(names)), key=total.__getitem__)
                low = total[best]
                scale = max(2.0, 0.01 * low)
                second = min((t for i, t in enumerate(total) if i != best), default=None)
                preds.append(names[best])
                scores.append(1.0 / sum(2.0 ** (-min(60.0, (t - low) / scale)) for t in total))
                rejects.append(second is not None and second - low < margin * second)
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(rejects, pa.bool_())],
                names=keep + ["lang_pred", "score", "rejected"])
        give_back()

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Rows that training never sees: crc32(key as text) mod 4 is 2."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of ``docs``."""
    slim = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    dictionaries = language_dictionaries(slim.where("not held_out"))
    return predict(slim.select("doc_id", "text", "held_out"), dictionaries, keep=["doc_id", "held_out"])


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, unchanged (all columns of simple type, extra ones of any name)."""
    slim = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    dictionaries = language_dictionaries(slim.where("not held_out"))
    return privately(docs, ["doc_id", "text", "lang"], lambda d: predict(d, dictionaries, keep=d.columns).where("not rejected"))
