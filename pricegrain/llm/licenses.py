"""Operator 3: licence scans with a positional rare-token index."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrain.llm.common import map_batches, texts

#: What the base places look for.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Label, notice text and the phrase in it that must stand word for word. A licence has a template for each of its sentences
#: that others do not share, since what stands between them varies.
TEMPLATES = [
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", "affero general public license"),
    ("agpl-3.0", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license", "gnu affero general public license as published"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "applicable law or agreed to in writing software"),
    ("boost-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "any person or organization obtaining a copy of the software"),
    ("boost-1.0", "distributed under the boost software license version 1 0", "boost software license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-4.0", "this work is licensed under the creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights", "waived all copyright"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "gnu general public license as published by the free software foundation either version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "gnu general public license as published by the free software foundation either version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software", "author disclaims all warranties with regard to this software"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license as published"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free of charge to any person obtaining a copy of this software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "shall be included in all copies or substantial portions of the software"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise", "shall the authors or copyright holders be liable for any claim"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software", "will the authors be held liable for any damages arising from the use of this software"),
]
#: The share of a template's IDF that must be found.
MIN_COVER = 0.5

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased (other letters as they are)."""
    return WORD.findall((text or "").encode().lower())


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """Documents in all, and documents with each word of the (small, given) vocabulary."""
    names = {w.decode(): w for w in vocabulary}

    def count(batches):
        seen: Counter = Counter()
        n = 0
        for batch in batches:
            for text in batch["text"]:
                seen.update(vocabulary.intersection(words_of(text)))
            n += len(batch["text"])
        yield {"word": [None, *(w.decode() for w in seen)], "n": [n, *seen.values()]}

    rows = map_batches(texts(docs), "word string, n long", count).groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    return found.get(None, 0), {w: found.get(name, 0) for name, w in names.items()}


class RareTokenIndex:
    """Postings (template, position) of the rare words of all templates, by their IDF in the corpus.

    Of each template as many positions are posted, rarest words first, as it takes for an alignment that matches MIN_COVER of the
    template's IDF to match two of them: all others and any one of these come to less. So a file's words
    are looked up, and only relative positions on which two postings agree are looked at. A template of which one
    word is worth MIN_COVER needs but one.
    """

    def __init__(self, templates, n_docs: int, df: dict[bytes, int]):
        self.idf = {w: math.log((n_docs + 1) / (c + 1)) + 0.01 for w, c in df.items()}
        self.templates, self.postings = [], defaultdict(list)
        for k, (label, notice, phrase) in enumerate(templates):
            words, key = notice.encode().split(), phrase.encode().split()
            at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
            rarest = sorted(range(len(words)), key=lambda i: (-self.idf[words[i]], i))
            total = sum(self.idf[w] for w in words)
            top, rest, posted = self.idf[words[rarest[0]]], total, 0
            need = 2 if top < MIN_COVER * total else 1
            while posted < len(words) and rest + (top if need == 2 else 0) >= MIN_COVER * total:
                rest -= self.idf[words[rarest[posted]]]
                posted += 1
            for i in rarest[:posted]:
                self.postings[words[i]].append((k, i))
            self.templates.append((label, words, at, key, total, min(need, posted)))
        #: Words that are looked up, those of highest IDF first.
        self.order = {w: n for n, w in enumerate(sorted(self.postings, key=lambda w: (-self.idf[w], w)))}

    def alignments(self, places: dict[bytes, list[int]]) -> list[tuple[int, int]]:
        """(template, start in the file) on which enough of the file's rare words agree."""
        votes: Counter = Counter()
        for w in sorted((w for w in places if w in self.order), key=self.order.__getitem__):
            here = self.postings[w]
            votes.update((k, p - i) for p in places[w] for k, i in here)
        return [a for a, n in votes.items() if n >= self.templates[a[0]][5]]

    def labels(self, words: list[bytes], places: dict[bytes, list[int]]) -> dict[str, float]:
        """Labels whose template lines up with the file, with the share of its IDF found there."""
        found: dict[str, float] = {}
        for k, start in self.alignments(places):
            label, template, at, key, total, _ = self.templates[k]
            if start + at < 0 or words[start + at : start + at + len(key)] != key:
                continue
            cover = sum(self.idf[w] for i, w in enumerate(template) if 0 <= start + i < len(words) and words[start + i] == w) / total
            if cover >= MIN_COVER:
                found[label] = max(cover, found.get(label, 0.0))
        return found


def license_scan(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """Licence phrases and notices in each whole text.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans (start
    word of each base phrase). Base places are exact. Further labels come from templates: the file's licence words, those of
    highest IDF over the whole corpus first, are looked up for the templates and positions that have them, postings are
    intersected by relative position, the template's mandatory phrase must stand there, and half of its IDF must
    match; no such place is lost. score is 1 with a base phrase, else the
    best share, else 0. A null text counts as empty: no words, empty labels, null places. Rows that are
    repeated give repeated rows. A very long text is held as the list of its words, one text at a time.
    """
    phrases = [(p.encode().split(), label) for p, label in base.items()]
    vocabulary = {w for _, notice, _ in templates for w in notice.encode().split()}
    index = RareTokenIndex(templates, *document_frequencies(docs, vocabulary))
    wanted = set(index.postings) | {p[0] for p, _ in phrases}
    names = "doc_id n_words n_base first_word last_word base_labels labels score spans".split()

    def scan(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = words_of(text)
                places = defaultdict(list)
                for i, w in enumerate(words):
                    if w in wanted:
                        places[w].append(i)
                starts, labels = [], set()
                for phrase, label in phrases:
                    here = [i for i in places.get(phrase[0], ()) if words[i : i + len(phrase)] == phrase]
                    starts += here
                    if here:
                        labels.add(label)
                more = index.labels(words, places)
                score = 1.0 if starts else min(1.0, max(more.values(), default=0.0))
                starts.sort()
                out.append((doc_id, len(words), len(starts), starts[0] if starts else None, starts[-1] if starts else None, ",".join(sorted(labels)), ",".join(sorted(labels | set(more))), score, starts))
            yield dict(zip(names, map(list, zip(*out)), strict=True))

    return map_batches(texts(docs), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<long>", scan)
