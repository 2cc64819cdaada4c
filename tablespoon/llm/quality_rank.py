"""Quality scores by Bradley-Terry ranking: a good text should beat a bad one.

Every text becomes a few numbers about its words, marks and lines. From labelled rows, pairs of a good and a bad text are
drawn, and a logistic model of the *differences* of their numbers is fitted; its weights give each text a strength. The
threshold is the quantile of strength that leaves as large a part below it as bad rows have among the labelled ones, and the
score is the chance to beat a text at the threshold.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablespoon.session import stored

SAMPLE = 20_000  # labelled rows of each class that may enter the fit; all of them where there are fewer
PARTNERS = 4  # pairs for each sampled row
FEATURES = (
    "log_words", "word_length", "word_spread", "distinct_words", "repeated_next", "repeated_windows", "distinct_lines",
    "symbols", "digits", "upper", "title", "end_marks", "commas", "shouts", "separators", "line_words",
)
_SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]\\^~=_@]")
_WINDOW = 8


def features(text: str) -> list[float]:
    """Numbers about a whole text, each between about 0 and 3; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lines = [line for line in text.split("\n") if line.strip()]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    chars = int(sizes.sum())
    ids: dict[str, int] = {}
    number = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    window = np.zeros(max(n - _WINDOW + 1, 0), dtype=np.uint64)
    for k in range(_WINDOW if len(window) else 0):
        window = window * np.uint64(0x9E3779B97F4A7C15) + number[k : k + len(window)].astype(np.uint64) + np.uint64(1)
    upper = sum(map(str.isupper, words))
    return [
        float(np.log1p(n)) / 4,
        float(sizes.mean()) / 5,
        float(sizes.std()) / 5,
        len(ids) / n,
        float((number[1:] == number[:-1]).mean()) if n > 1 else 0.0,
        1 - len(np.unique(window)) / len(window) if len(window) else 0.0,
        len(set(lines)) / len(lines),
        min(3.0, 10 * len(_SYMBOLS.findall(text)) / chars),
        min(3.0, 10 * sum(map(text.count, "0123456789")) / chars),
        upper / n,
        sum(map(str.istitle, words)) / n,
        min(3.0, 5 * (text.count(".") + text.count("?")) / n),
        min(3.0, 5 * text.count(",") / n),
        min(3.0, 5 * text.count("!") / n),
        sum(w in "|»>·•-/" for w in words) / n,
        float(np.log1p(n / len(lines))) / 3,
    ]


def with_features(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(x.as_py() or "") for x in batch.column(batch.schema.get_field_index(text))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(key)), pa.array(made, pa.list_(pa.float64()))], [key, "x"]
            )

    return docs.select(key, text).mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, x array<double>")


def held_out(key: str) -> Column:
    """Rows that are never learned from: crc32 of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _pairs(sample: DataFrame, partners: int) -> DataFrame:
    """Differences of features (first minus second) with label 1 if the first is the good one; sides are dealt by hash."""
    numbered = sample.withColumn("at", F.row_number().over(Window.partitionBy("label").orderBy("hash", "doc")) - 1)
    numbered = stored(numbered, "sample")
    good, bad = numbered.where("label = 1"), numbered.where("label = 0")
    sizes = numbered.agg(F.count_if(F.col("label") == 1).alias("g"), F.count_if(F.col("label") == 0).alias("b"))
    # each row of the larger class meets ``partners`` rows of the other
    slots = F.explode(F.sequence(F.lit(0), F.greatest("g", "b") * partners - 1))
    met = sizes.where("g > 0 AND b > 0").select("g", "b", slots.alias("slot"))
    step = F.floor(F.col("slot") / F.greatest("g", "b"))
    met = met.select(
        "slot", F.pmod(F.col("slot") + step * 7919, F.col("g")).alias("gi"), F.pmod(F.col("slot") + step * 104729, F.col("b")).alias("bi")
    )
    both = met.join(good.select(F.col("at").alias("gi"), F.col("x").alias("gx")), "gi").join(
        bad.select(F.col("at").alias("bi"), F.col("x").alias("bx")), "bi"
    )
    first = F.pmod(F.xxhash64("slot"), F.lit(2)) == 0
    difference = F.zip_with("gx", "bx", lambda a, b: F.when(first, a - b).otherwise(b - a))
    return both.select(array_to_vector(difference).alias("features"), first.cast("double").alias("label"))


def rank_quality(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
    partners: int = PARTNERS,
) -> DataFrame:
    """(key, held_out, score, predicted, strength) of every row of ``docs``.

    Learns from different labelled rows whose key is not held out, at most ``sample`` of each class (those of least hash). Null and
    empty texts have features 0 and a score like any other; a null key has no label and is not held out; repeated rows get
    equal scores, and enter the sample once. Rows with a null label are not learned from; of several labels
    of one key the largest counts. With only one class, or no
    labels, every score is 0.5.
    """
    scored = stored(with_features(docs, key, text), "features").withColumnRenamed(key, "doc")
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("doc")).agg(F.max(label).alias("label"))
    learned = scored.where(~held_out("doc")).join(known, "doc")
    learned = stored(learned, "learned")
    shares = learned.agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")).first()
    if not shares.good or not shares.bad:
        strength, bound = F.lit(0.0), 0.0
    else:
        # each different row once; rows of one key have hashes of their own, so none enters or leaves with the others
        different = stored(learned.select("doc", "label", "x").distinct().withColumn("hash", F.xxhash64("doc", "x")), "different")
        # hashes below these bounds are about ``sample`` rows of a class; the window then sees no more than that
        most = {r.label: r["count"] for r in different.where("label IN (0, 1)").groupBy("label").count().toLocalIterator()}
        few = different.where("false")
        for value, n in most.items():
            part = min(1.0, 1.2 * sample / n)
            few = few.unionByName(
                different.where((F.col("label") == value) & (F.pmod("hash", F.lit(1 << 20)) < int(part * (1 << 20))))
            )
        ordered = Window.partitionBy("label").orderBy("hash", "doc")
        few = few.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= sample).drop("rank")
        model = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=100, standardization=True).fit(_pairs(few, partners))
        weights = [round(float(w), 9) for w in model.coefficients]
        strength = F.aggregate(
            F.zip_with("x", F.array(*map(F.lit, weights)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v
        )
        ranked = learned.select(strength.alias("strength"))
        bound = ranked.agg(F.percentile_approx("strength", shares.bad / (shares.good + shares.bad), 100_000)).first()[0]
    score = 1 / (1 + F.exp(-(strength - F.lit(bound))))
    out = scored.select(F.col("doc").alias(key), held_out("doc").alias("held_out"), score.alias("score"), strength.alias("strength"))
    return out.select(key, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "strength")
