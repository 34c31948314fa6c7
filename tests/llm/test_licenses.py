"""Licence templates against every alignment, and the usual headers told apart."""

import random
from collections import defaultdict

import pytest

from pricegrain.llm import licenses

HEADERS = {
    "gpl-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    "agpl-3.0": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-3-clause": "Neither the name of the Example Company nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "epl": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "zlib": "In no event will the authors be held liable for any damages arising from the use of this software.",
    "boost-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
}
BODIES = {
    "mit": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE',
    "apache-2.0": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES',
    "isc": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE',
}


def test_headers_and_bodies_are_told_apart(spark):
    texts = [*HEADERS.items(), *BODIES.items()]
    plain = ["a plain text about any software", "the license of the software is not told here", "in no event shall the holders be liable"]
    docs = spark.createDataFrame([(i, f"// some file\n// {t}\n int main") for i, (_, t) in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(plain)], "doc_id long, text string")
    got = {r["doc_id"]: set(r["labels"].split(",")) - {"", "apache", "gpl"} for r in licenses.license_scan(docs).collect()}
    for i, (label, _) in enumerate(texts):
        assert got[i] == {label}, label
    assert not any(got[100 + i] for i in range(len(plain)))


@pytest.mark.parametrize("seed", range(4))
def test_no_alignment_is_lost(seed):
    rng = random.Random(seed)
    vocabulary = sorted({w for _, notice, _ in licenses.TEMPLATES for w in notice.encode().split()})
    df = {w: rng.choice([0, 0, 1, 5, 300, 900]) for w in vocabulary}
    index = licenses.RareTokenIndex(licenses.TEMPLATES, 1000, df)
    seen = 0
    for _ in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 20))]
        for _ in range(rng.randint(1, 3)):
            _, notice, phrase = rng.choice(licenses.TEMPLATES)
            notice, key = notice.encode().split(), phrase.encode().split()
            at = next(i for i in range(len(notice)) if notice[i : i + len(key)] == key)
            words += [w if at <= i < at + len(key) or rng.random() < 0.6 else rng.choice([b"other", rng.choice(vocabulary)]) for i, w in enumerate(notice)][rng.choice([0, 0, at]) :]
        places = defaultdict(list)
        for i, w in enumerate(words):
            places[w].append(i)
        want = {}
        for label, notice, phrase in licenses.TEMPLATES:
            notice, key = notice.encode().split(), phrase.encode().split()
            at = next(i for i in range(len(notice)) if notice[i : i + len(key)] == key)
            total = sum(index.idf[w] for w in notice)
            for start in range(-len(notice), len(words)):
                if start + at >= 0 and words[start + at : start + at + len(key)] == key:
                    cover = sum(index.idf[w] for i, w in enumerate(notice) if 0 <= start + i < len(words) and words[start + i] == w) / total
                    if cover >= licenses.MIN_COVER:
                        want[label] = max(cover, want.get(label, 0.0))
        assert index.labels(words, places) == want
        seen += len(want)
    assert seen > 100
