"""Operator 1: language identification by rank-order n-gram profiles."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricegrain.llm.common import append_columns, map_batches, texts

#: N-grams that a profile keeps, of a document and of a language.
PROFILE = 400
UNDETERMINED = "und"
#: Stands for what is no letter; above 0, so that codes of different lengths differ.
BLANK = 1
#: Characters of a text that are counted at a time.
CHUNK = 1 << 20
#: Most languages that can be learnt; what is sent to the workers is bounded by it.
MOST_LANGS = 4096


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def gram_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the letter n-grams (n from 1 to 3) of a lower-cased text.

    A run of other characters counts as one blank, as do both ends; a code holds 21 bits for each
    character, so no two n-grams share one. Long texts are counted CHUNK characters at a time.
    """
    text = text.lower()
    last = np.array([BLANK], np.int64)  # the two symbols before the chunk
    parts = []
    for at in range(0, max(1, len(text)), CHUNK):
        a = np.frombuffer(text[at : at + CHUNK].encode("utf-32-le", "replace"), np.uint32)
        x = np.concatenate((last, np.where(letters[a], a, BLANK), [BLANK] if at + CHUNK >= len(text) else [])).astype(np.int64)
        old = len(last)
        keep = np.concatenate((np.ones(old, bool), (x[old:] != BLANK) | (x[old - 1 : -1] != BLANK)))
        x = x[keep]
        if len(x) - old:
            pairs = x[:-1] << 21 | x[1:]
            triples = (pairs[:-1] << 21 | x[2:])[x[1:-1] != BLANK]
            new = x[old:]
            parts.append(np.unique(np.concatenate((new[new != BLANK], pairs[old - 1 :], triples)), return_counts=True))
            last = x[-2:]
    return added(parts) if len(parts) != 1 else parts[0]


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all parts, each once, and their counts in all."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)


def profile_table(docs: DataFrame, learn_from: Column) -> DataFrame:
    """lang, code, rank of the ``PROFILE`` most frequent n-grams of each non-null ``lang``, over all rows that may be learnt from."""

    def count(batches):
        letters = letter_table()
        for batch in batches:
            by_lang: dict[str, list] = {}
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                codes, counts = gram_counts(text, letters)
                if len(codes):
                    by_lang.setdefault(lang, []).append((codes, counts))
            for lang, parts in by_lang.items():
                codes, n = added(parts)
                yield {"lang": [lang] * len(codes), "code": codes, "n": n}

    known = docs.filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = map_batches(texts(known, F.col("lang").cast("string").alias("lang")), "lang string, code long, n long", count)
    total = counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = (F.desc("n"), F.asc("code"))
    # the top of each slice of a language first, so that no task sees all n-grams of one language
    first = total.withColumn("rank", F.row_number().over(Window.partitionBy("lang", F.pmod("code", F.lit(31))).orderBy(*order))).filter(F.col("rank") <= PROFILE)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)) - 1).filter(F.col("rank") < PROFILE).select("lang", "code", "rank")


@dataclass
class Profiles:
    """Rank of every profiled n-gram in every language; at most MOST_LANGS x PROFILE entries."""

    langs: list[str]
    codes: np.ndarray
    ranks: np.ndarray  # n-grams x languages, PROFILE where a language lacks the n-gram

    @classmethod
    def of(cls, table: DataFrame) -> Profiles:
        rows = table.limit(MOST_LANGS * PROFILE + 1).collect()
        if len(rows) > MOST_LANGS * PROFILE:
            raise ValueError(f"lang has more than {MOST_LANGS} values")
        langs = sorted({r["lang"] for r in rows})
        codes = np.unique(np.array([r["code"] for r in rows], np.int64))
        ranks = np.full((len(codes) + 1, len(langs)), PROFILE, np.int32)
        for r in rows:
            ranks[np.searchsorted(codes, r["code"]), langs.index(r["lang"])] = r["rank"]
        return cls(langs, codes, ranks)

    def distances(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a document to each language, as a share of the largest possible."""
        top = codes[np.lexsort((codes, -counts))[:PROFILE]]
        at = np.searchsorted(self.codes, top)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != top)] = len(self.codes)
        places = np.arange(len(top))[:, None]
        ranks = self.ranks[at]
        return np.where(ranks == PROFILE, PROFILE, np.abs(ranks - places)).sum(0) / (PROFILE * len(top))


def predict_language(docs: DataFrame, learn_from: Column) -> DataFrame:
    """Language of each whole text by the nearest rank-order profile.

    ``learn_from`` marks the rows whose text and lang may be learnt from. Returns doc_id, lang_pred, score
    and distance. score is d2 / (d1 + d2) for the two nearest languages (0.5: they tie, as all do for a text
    of no known n-gram; with one language 1 - d1), 0 for ``und``. ``und`` stands for texts that are null,
    empty or without a letter, and for all texts where nothing could be learnt. Equal distances go to the
    language first in order of its name. Repeated rows and null ids stay as they are; a very long text is
    counted piece by piece. More than MOST_LANGS languages are an error.
    """
    return with_language(texts(docs), docs, learn_from, ("lang_pred", "score", "distance")).drop("text")


def with_language(rows: DataFrame, docs: DataFrame, learn_from: Column, names: tuple[str, str, str]) -> DataFrame:
    """``rows`` with language, score and distance of their text, learnt from ``docs``, in columns of these names."""
    profiles = docs.sparkSession.sparkContext.broadcast(Profiles.of(profile_table(docs, learn_from)))

    def predict(batches):
        letters, known = letter_table(), profiles.value
        for batch in batches:
            langs, scores, distances = [], [], []
            for text in batch["text"]:
                codes, counts = gram_counts(text or "", letters)
                # an n-gram of one letter at least, which a text without letters lacks
                if not len(codes) or not known.langs:
                    langs.append(UNDETERMINED), scores.append(0.0), distances.append(1.0)
                    continue
                d = known.distances(codes, counts)
                order = np.argsort(d, kind="stable")
                d1 = float(d[order[0]])
                d2 = float(d[order[1]]) if len(order) > 1 else None
                langs.append(known.langs[order[0]])
                scores.append(1 - d1 if d2 is None else d2 / (d1 + d2) if d2 else 0.5)
                distances.append(d1)
            yield dict(zip(names, (langs, scores, distances), strict=True))

    return append_columns(rows, ["text"], dict(zip(names, ("string", "double", "double"), strict=True)), predict)
