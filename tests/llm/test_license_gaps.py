"""Every sentence signature is found whatever separates its words."""

import re

from scoreflow.llm.license_scan import SENTENCES, license_scan

SAMPLES = [
    "permission is hereby granted free of charge to any person obtaining a copy",
    "permission to use copy modify and or distribute this software for any purpose",
    "redistribution and use in source and binary forms with or without modification",
    "this is free and unencumbered software released into the public domain",
    "free software foundation either version 2 of the license",
    "this program is free software you can redistribute it and or modify",
    "all rights reserved",
    "released into the public domain",
    "copyright c 2019",
    "without warranty of any kind",
]
GAPS = [" ", "  ", "\n", "\r\n// ", "\n# ", "\n * ", "\t", ", ", " -- ", "`_[", "{@}", "\x00"]


def test_sentences_with_line_breaks_and_comment_signs(frame):
    assert all(re.search(s[0], text) for s, text in zip(SENTENCES, SAMPLES, strict=True))
    rows = []
    for i, text in enumerate(SAMPLES):
        for j, gap in enumerate(GAPS):
            rows.append((i * 100 + 2 * j, f"x{gap}" + text.replace(" ", gap) + f"{gap}y"))
            rows.append((i * 100 + 2 * j + 1, text.replace(" ", gap).upper()))
    out = {r.doc_id: (r.labels, r.n_detections, r.score) for r in license_scan(frame(rows)).collect()}
    assert len(out) == len(rows)
    for i, sentence in enumerate(SENTENCES):
        label, _, _, confidence = sentence[1:]
        assert label in out[i * 100][0].split(",") and out[i * 100][1] > 0 and out[i * 100][2] >= confidence
    assert {d: e for d, e in out.items() if e != out[d // 100 * 100]} == {}
