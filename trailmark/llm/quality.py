"""Quality rules by divergence from language references.

Two histograms describe a text: its characters by class, and its words by which of the
language's most common words they are. Each is compared with the same histogram pooled
over all texts of the language by Jensen-Shannon distance (0: equal, 1: disjoint). Short
texts are noisy samples of their language, so each comparison has a minimum length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trailmark.llm.common import stored, text_of

# The characters counted as symbols and the white space between words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

CLASSES = ("blank", "lower", "upper", "digit", "stop", "symbol", "accented", "other")

# Counted words are handed on when a task holds this many; sums do not depend on it.
FLUSH = 400_000

BASE_SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint"
)


@dataclass(frozen=True)
class Rules:
    """Distances above the limits reject a text that is long enough to be compared."""

    common_words: int = 40
    min_chars: int = 200
    min_words: int = 100
    class_limit: float = 0.28
    word_limit: float = 0.45


@dataclass(frozen=True)
class References:
    """Per language: class shares, and the common words with their shares (last: the rest)."""

    classes: dict[str, np.ndarray] = field(default_factory=dict)
    words: dict[str, tuple[dict[bytes, int], np.ndarray]] = field(default_factory=dict)


def _class_table() -> np.ndarray:
    """Class of each code point below 0x250; all others are 'other'."""
    table = np.full(0x250 + 1, CLASSES.index("other"), np.uint8)
    for code in range(0x250):
        char = chr(code)
        if char in BLANKS:
            name = "blank"
        elif char in SYMBOLS:
            name = "symbol"
        elif code >= 0xC0 and char.isalpha():
            name = "accented"
        elif char.isascii() and char.isalpha():
            name = "lower" if char.islower() else "upper"
        elif char.isascii() and char.isdigit():
            name = "digit"
        elif char in ".,;:!?'\"()-":
            name = "stop"
        else:
            continue
        table[code] = CLASSES.index(name)
    return table


_CLASS_OF = _class_table()


def class_counts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(_CLASS_OF[np.minimum(codes, 0x250)], minlength=len(CLASSES))


def repeated_words(words: list[bytes]) -> int:
    """Words in a window of three words that occurs twice or more, its first time included."""
    if len(words) < 4:
        return 0
    codes: dict[bytes, int] = {}
    each = np.array([codes.setdefault(word, len(codes)) for word in words], np.int64)
    pairs = np.unique(each[:-1] * len(codes) + each[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(codes) + each[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[place] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """The columns of ``BASE_SCHEMA``."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of a histogram and reference shares."""
    p = counts / counts.sum()
    middle = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum()
        right = np.where(reference > 0, reference * np.log2(reference / middle), 0).sum()
    return float(np.sqrt(max(0.0, (left + right) / 2)))


def build_references(
    docs: DataFrame, rules: Rules, text_col: str = "text", lang_col: str = "lang"
) -> References:
    """Histograms pooled over every text of each language (null: its own group).

    Tasks count first and shuffle sums; the driver gets ``common_words`` + 8 rows for each
    language. Languages are codes, of which there is a fixed number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        classes: dict[str, np.ndarray] = {}

        def made() -> pa.RecordBatch:
            rows = [(lang, None, word, n) for (lang, word), n in words.items()]
            for lang, counts in classes.items():
                rows += [(lang, k, None, int(n)) for k, n in enumerate(counts)]
            words.clear()
            classes.clear()
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = [pa.string(), pa.int32(), pa.binary(), pa.int64()]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["lang", "class", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                text = text.as_py()
                counted = Counter(text.encode().lower().split())
                for word, n in counted.items():
                    words[lang, word] += n
                classes[lang] = classes.get(lang, 0) + class_counts(text)
                if len(words) > FLUSH:
                    yield made()
        yield made()

    texts = docs.select(docs[lang_col].alias("lang"), text_of(text_col).alias("text"))
    schema = "lang string, class int, word binary, n bigint"
    counts = texts.mapInArrow(run, schema).groupBy("lang", "class", "word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "quality-counts")
    first = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = (
        counts.where("word is not null")
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= rules.common_words)
    )
    totals = counts.where("word is not null").groupBy("lang").agg(F.sum("n").alias("total"))
    total = {row.lang: row.total for row in totals.collect()}
    references = References()
    for row in counts.where("class is not null").collect():
        shares = references.classes.setdefault(row.lang, np.zeros(len(CLASSES)))
        shares[row["class"]] = row.n
    rows: dict[str, list] = {}
    for row in common.collect():
        rows.setdefault(row.lang, []).append(row)
    for lang, found in rows.items():
        found.sort(key=lambda row: row.place)
        shares = np.array([row.n for row in found] + [0], float)
        shares[-1] = total[lang] - shares.sum()
        places = {bytes(row.word): row.place - 1 for row in found}
        references.words[lang] = places, shares / shares.sum()
    for lang, shares in list(references.classes.items()):
        if shares.sum():
            references.classes[lang] = shares / shares.sum()
        else:
            del references.classes[lang]
    return references


def _nearest(distances: dict[str, float], lang: str | None) -> float | None:
    return distances.get(lang, min(distances.values(), default=None))


def divergences(text: str, words: list[bytes], lang: str | None, references: References, rules: Rules):
    """(class distance, word distance): None where the text is too short to compare.

    A language without a reference is compared with the nearest reference.
    """
    far_class = far_word = None
    if len(text) >= rules.min_chars:
        counts = class_counts(text)
        known = {lang: references.classes[lang]} if lang in references.classes else references.classes
        far_class = _nearest({k: distance(counts, v) for k, v in known.items()}, lang)
    if len(words) >= rules.min_words:
        known = {lang: references.words[lang]} if lang in references.words else references.words
        found = {}
        for name, (places, shares) in known.items():
            rest = len(shares) - 1
            place = [places.get(word, rest) for word in map(bytes.lower, words)]
            found[name] = distance(np.bincount(place, minlength=len(shares)), shares)
        far_word = _nearest(found, lang)
    return far_class, far_word


def assess(
    docs: DataFrame,
    rules: Rules = Rules(),
    references: References | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """(id, base counts, base_failed, class_distance, word_distance, kept) of every text.

    Null texts have no words and fail the base rules; null ids and repeated rows stay rows
    of their own. ``references`` default to those of ``docs`` themselves. No shuffle.
    """
    known = build_references(docs, rules, text_col, lang_col) if references is None else references
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {BASE_SCHEMA}, class_distance double, word_distance double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                text = text.as_py()
                words = text.encode().split()
                far = divergences(text, words, lang, known, rules)
                rows.append((*base_counts(text, words), *far))
            kinds = [pa.int64()] * 5 + [pa.float64()] * 2
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            names = [part.split()[0] for part in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], names)

    texts = docs.select(
        docs[id_col].alias("id"), docs[lang_col].alias("lang"), text_of(text_col).alias("text")
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= rules.class_limit) & (
        F.coalesce("word_distance", F.lit(0.0)) <= rules.word_limit
    )
    measured = texts.mapInArrow(run, schema).withColumn("base_failed", failed)
    return measured.withColumn("kept", ~F.col("base_failed") & near).withColumnRenamed("id", id_col)
