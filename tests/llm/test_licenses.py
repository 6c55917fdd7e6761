import re

from flowtally.llm import licenses

SCHEMA = "doc_id long, text string, labels string, row string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    starts, base, labels, score = [], set(), set(), 0.0
    templates = [(n, p, p, True) for n, p in licenses.BASE] + [(*t, False) for t in licenses.TEMPLATES]
    for label, text, key, is_base in templates:
        listed, phrase = text.split(), key.split()
        at = next(i for i in range(len(listed)) if listed[i:i + len(phrase)] == phrase)
        for s in range(-len(listed), len(words)):
            same = [w == "*" or 0 <= s + i < len(words) and words[s + i] == w for i, w in enumerate(listed)]
            named = [ok for ok, w in zip(same, listed) if w != "*"]
            support = sum(named) / len(named)
            if all(same[at:at + len(phrase)]) and support >= licenses.SUPPORT:
                labels.add(label)
                score = max(score, support)
                if is_base:
                    base.add(label)
                    starts.append(s)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9))


TEXTS = [
    None, "", "...", "MIT License", "mit license mit license", "(MIT) licenseX mit-license", "Released under the MIT License.",
    "the GNU General Public License, version 3.", "gnu general public licence", "CC BY-NC 4.0 and cc by", "Kby cc by",
    "Licensed under the Apache License, Version 2.0", "apache license", "GNU\x00GENERAL\nPUBLIC--LICENSE v2",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "éMIT license", "MIT License",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "by " * 500 + "cc by " * 300, "word " * 20000 + "gnu general public license version 2",
    "under Apache License Version 2 0", "gnu lesser general public license gnu affero general public license",
]


def test_against_brute_force(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(3, "MIT License", "", ""), (None, "cc by", "", "")]
    out = licenses.scan(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    got = sorted(((r["doc_id"], (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"],
                                 r["labels"], round(r["score"], 9))) for r in out), key=repr)
    assert got == sorted(((r[0], brute(r[1])) for r in rows), key=repr)


def test_no_rows(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0
