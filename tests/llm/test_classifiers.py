"""Quality network and licence classifier: held-out accuracy and defined results."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from symgrid.llm import conv_quality, licences, queries

SF_DIR = "/root/testdata/sf0.01"


def test_gradients_of_the_network_lower_the_loss():
    rng = random.Random(2)
    good = ["".join(rng.choice("etaoin ") for _ in range(rng.randrange(1, 1500))) for _ in range(60)]
    bad = [text[: len(text) // 2] + "### !!" + text[len(text) // 2 :] for text in good]
    sample = [(t.encode(), int(k < 60)) for k, t in enumerate(good + bad)]
    net = conv_quality.train(sample)
    scores = np.array([net.score(t) for t in good + bad])
    assert scores[:60].mean() > 0.8 > 0.2 > scores[60:].mean()


def test_chunks_cover_the_whole_text():
    net = conv_quality.constant_network(0.5)
    net.filters[:, ord("#")] = 1.0
    net.weights[: conv_quality.FILTERS] = 1.0
    for at in (0, 255, 256, 511, 513, 40_000, 69_999):
        text = "a" * at + "#" + "a" * (69_999 - at)
        assert net.score(text) > 0.99
    assert net.score("") == net.score(None) == 0.5 == net.score("aaa")


def random_network(seed):
    rng = np.random.default_rng(seed)
    return conv_quality.Network(
        rng.normal(0, 0.3, (conv_quality.WIDTH, 256, conv_quality.FILTERS)).astype(np.float32),
        rng.normal(0, 0.3, conv_quality.FILTERS).astype(np.float32), rng.normal(0, 0.3, 2 * conv_quality.FILTERS).astype(np.float32), 0.2,
    )


def brute_chunks(net, raw):
    """Per chunk and filter the greatest response and where, from the definition."""
    data = [*raw, *[0] * (conv_quality.WIDTH - 1)]
    at = np.array([sum(net.filters[k, data[p + k]] for k in range(conv_quality.WIDTH)) for p in range(len(raw))])
    half = conv_quality.CHUNK // 2
    chunks = [at[s : s + 2 * half] for s in range(0, max(1, len(raw) - half), half)]
    return np.array([c.max(axis=0) for c in chunks]), np.array([c.argmax(axis=0) + half * i for i, c in enumerate(chunks)])


def test_scores_and_training_peaks_against_the_definition(docs, monkeypatch):
    monkeypatch.setattr(conv_quality, "SLICE", 1024)
    net, rng = random_network(5), random.Random(6)
    sizes = [1, 2, 4, 5, 255, 256, 257, 511, 512, 513, 768, 1023, 1024, 1025, 3000, 5000]
    texts = ["".join(rng.choice("abcdé #\n") for _ in range(n)) for n in sizes]
    scored = docs(list(enumerate(texts))).select("doc_id", conv_quality.quality_score(F.col("text"), net).alias("s"))
    found = {r.doc_id: r.s for r in scored.collect()}
    for n, text in enumerate(texts):
        peaks, places = brute_chunks(net, text.encode())
        relu = np.maximum(peaks + net.bias, 0)
        logit = np.concatenate((relu.max(axis=0), relu.mean(axis=0))) @ net.weights + net.offset
        assert abs(found[n] - 1 / (1 + np.exp(-logit))) < 1e-4
        got, where = net.chunk_peaks(np.frombuffer(text.encode(), np.uint8))
        assert np.allclose(got, peaks, atol=1e-5) and got.shape == peaks.shape
        assert (where == places).mean() > 0.99  # sums in another order may break a tie elsewhere


def test_training_sees_what_only_the_middle_of_a_long_text_shows():
    rng = random.Random(4)
    good = ["".join(rng.choice("etaoin ") for _ in range(rng.randrange(9000, 12000))) for _ in range(40)]
    bad = []
    for text in good:
        at = rng.randrange(100, len(text) - 100)
        bad.append(text[:at] + "#%#%#" + text[at:])
    sample = [(t.encode(), int(k < 40)) for k, t in enumerate(good + bad)]
    net = conv_quality.train(sample)
    scores = np.array([net.score(t) for t in good + bad])
    assert scores[:40].mean() > 0.8 > 0.2 > scores[40:].mean()


def test_held_out_accuracy_of_the_query(spark):
    scored = queries.op2_quality_classifier(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert scored.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_no_labels_or_one_class(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    texts = docs([(1, "a"), (2, None), (3, "")])
    for known in (labels, labels.where("doc_id > 5")):
        network = conv_quality.train(conv_quality.training_sample(texts, known))
        scores = [r.s for r in texts.select(conv_quality.quality_score(F.col("text"), network).alias("s")).collect()]
        assert len(set(scores)) == 1 and 0 < scores[0] < 1


def test_licences(spark, docs):
    filler = "Some other words of the text stand here\nand in the next line of it too"
    rows = [(i, f"{filler} {i}") for i in range(40)]
    rows += [(100, f"{filler}\nLicensed under the Apache License, Version 2.0."), (101, "Released under the MIT License."), (102, "All rights reserved."),
             (103, "This work is licensed under the GNU General Public License, version 3."), (104, None), (105, ""), (106, "Licensed under CC BY-NC 4.0."),
             (107, "Licensed under the Moonbeam License."), (107, "Licensed under the Moonbeam License.")]
    found = licences.find_licences(docs(rows)).collect()
    named = {r.doc_id: (r.family, r.paragraph) for r in found}
    assert {k: v for k, v in named.items() if k < 107} == {
        100: ("Apache-2.0", 2), 101: ("MIT", 0), 102: ("Proprietary", 0), 103: ("GPL-3.0", 0), 106: ("CC-BY-NC-4.0", 0),
    }
    assert all(r.family == licences.UNKNOWN and not r.confirmed for r in found if r.doc_id == 107)
    assert licences.find_licences(docs([])).collect() == []
    assert licences.find_licences(docs([(1, None)])).collect() == []


def test_licences_of_the_query(spark):
    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
        "All rights reserved.": "Proprietary",
    }
    texts = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, k): lines[line] for r in texts for k, line in enumerate(r.text.split("\n")) if line in lines}
    assert {(r.doc_id, r.paragraph): r.family for r in queries.op8_licences(spark, SF_DIR).collect()} == want


WRAPPED = {
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:": "BSD-3-Clause",
    "Licensed under the Apache\nLicense, Version 2.0.": "Apache-2.0",
    '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy': "Apache-2.0",
    " * Permission is hereby granted, free of charge, to any person\n * obtaining a copy of this software and associated\n * documentation files": "MIT",
    **{
        f"This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {name}General Public License as published by\n"
        f"the Free Software Foundation, either version {version} of the License, or\n(at your option) any later version.": family
        for name, version, family in (("", 3, "GPL-3.0"), ("", 2, "GPL-2.0"), ("Lesser ", 3, "LGPL"), ("Affero ", 3, "AGPL-3.0"))
    },
}


def test_wrapped_licences(docs):
    filler = "Some other words of the text stand here\nand in the next line of it too"
    rows = [(i, f"{filler} {i}") for i in range(40)]
    rows += [(100 + k, f"{filler}\n\n{notice}\n{filler}") for k, notice in enumerate(WRAPPED)]
    # A notice ends where a line does not go on with it, and at a line without words.
    rows += [(200, "Licensed under the Apache License, Version 2.0.\nAll rights reserved."), (201, "Licensed under the Apache\n\nLicense, Version 2.0.")]
    found = licences.find_licences(docs(rows)).collect()
    named = {r.doc_id: (r.family, r.paragraph) for r in found if r.doc_id < 200}
    assert named == {100 + k: (family, 3) for k, family in enumerate(WRAPPED.values())}
    assert len([r for r in found if r.doc_id < 200]) == len(WRAPPED)
    assert {(r.paragraph, r.family) for r in found if r.doc_id == 200} == {(0, "Apache-2.0"), (1, "Proprietary")}
    assert not any(r.confirmed for r in found if r.doc_id == 201)


def test_table_of_licences_alone(docs):
    rows = [(1, "Licensed under the Apache License, Version 2.0."), (2, "Released under the MIT License."), (3, "All rights reserved.")]
    found = licences.find_licences(docs(rows)).collect()
    assert {(r.doc_id, r.family, r.confirmed) for r in found} == {(1, "Apache-2.0", True), (2, "MIT", True), (3, "Proprietary", True)}


def test_wording_without_known_ngrams_is_unknown(docs):
    rows = [(1, "ISC licence"), (2, "Copyright (c) 2020 Jane Doe"), (3, "A plain line\nlicence: yes"), (4, "Nothing of the kind is said here."), (5, "")]
    found = licences.find_licences(docs(rows)).collect()
    assert {(r.doc_id, r.paragraph, r.family, r.confirmed) for r in found} == {
        (1, 0, "unknown", False), (2, 0, "unknown", False), (3, 1, "unknown", False)
    }


def test_licences_against_plain_arithmetic(docs, monkeypatch):
    """Probability, family and cover of every paragraph, from the classifier's numbers by hand."""
    prose = ["the terms of the peace", "you may not go", "words of the day", "nothing"]
    lines = [notice for _, notice in licences.NOTICES] + [" ".join(notice.split()[1:-1]) for _, notice in licences.NOTICES] + prose
    table = docs(list(enumerate(lines)))
    classifier = licences.train(table)
    monkeypatch.setattr(licences, "train", lambda *_: classifier)
    found = {r.doc_id: r for r in licences.find_licences(table).collect()}
    for doc_id, line in enumerate(lines):
        words = [w for w in re.split(r"[^\w]+|_", line.lower()) if w]
        grams = {" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}
        hits = [k for k, gram in enumerate(classifier.vocabulary) if gram in grams]
        if not hits:
            assert (doc_id in found) == bool(re.search(licences.LICENCE_WORDS, line))
            continue
        logits = (classifier.bias + classifier.weights[:, hits].sum(axis=1)) / classifier.temperature
        shares = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        family = classifier.families[int(shares.argmax())]
        if family == licences.NONE:
            assert doc_id not in found
            continue
        held = {classifier.vocabulary[k] for k in hits}
        numbered = lambda own: [g for g in own if any(map(str.isdigit, g))]
        cover = max((len(held & set(own)) / len(own) for name, own in classifier.notices if name == family and (not numbered(own) or held & set(numbered(own)))), default=0.0)
        sure = shares.max() >= licences.MIN_PROBABILITY and cover >= licences.MIN_COVERED
        row = found[doc_id]
        assert (row.family, row.confirmed) == (family if sure else licences.UNKNOWN, sure)
        assert abs(row.probability - shares.max()) < 1e-9 and abs(row.covered - cover) < 1e-12


def test_accuracy_on_unseen_wording(docs):
    """Notices in words that the classifier was not trained on, and prose; known families found, none made up."""
    unseen = [
        ("Apache-2.0", "This file is licensed to you under the Apache License, Version 2.0, see the file for details."),
        ("MIT", "The code here is released under the MIT License by its authors."),
        ("GPL-3.0", "The program is licensed under the GNU General Public License, version 3, or any later one."),
        ("GPL-2.0", "Parts are licensed under the GNU General Public License, version 2, as stated."),
        ("AGPL-3.0", "The server is licensed under the GNU Affero General Public License, version 3, unlike the client."),
        ("MPL-2.0", "Our Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0, and no other."),
        ("CC-BY-SA-4.0", "The pictures are licensed under CC BY-SA 4.0."),
        ("CC-BY-4.0", "All figures are licensed under CC BY 4.0."),
        ("Proprietary", "Example Corp. All rights reserved."),
        *[(None, f"The weather of the day was fine in town {k}, and the people went to the park.") for k in range(20)],
    ]
    found = {r.doc_id: r.family for r in licences.find_licences(docs([(k, text) for k, (_, text) in enumerate(unseen)])).collect()}
    right = sum(found.get(k) == family for k, (family, _) in enumerate(unseen))
    assert right >= 0.9 * len(unseen)
