"""Every hand-written signature: texts that it finds and near misses."""

import re
from re import _constants as c
from re import _parser

import pytest

from scoreflow.llm.license_scan import TRIGGER, license_scan, signature_rules
from scoreflow.llm.license_signatures import signatures


def _sample(nodes, full):
    """A text that the parsed pattern matches: with all that is optional and
    the last of its alternatives, or without and the first of them."""
    return re.sub(" +", " ", _written_out(nodes, full)).strip()


def _written_out(nodes, full):
    out = ""
    for op, value in nodes:
        if op is c.LITERAL:
            out += chr(value)
        elif op is c.ANY:
            out += "x"
        elif op is c.IN:
            kind, v = value[-1 if full else 0]
            out += chr(v if kind is c.LITERAL else v[1 if full else 0])
        elif op is c.SUBPATTERN:
            out += _written_out(value[3], full)
        elif op is c.BRANCH:
            out += _written_out(value[1][-1 if full else 0], full)
        elif op is c.MAX_REPEAT:
            low, high, inner = value
            filler = len(inner) == 1 and inner[0][0] is c.ANY
            if filler:
                out += "some other words "[: max(low, 2)] if low else ("other words " if full else "")
            else:
                out += _written_out(inner, full) * (min(high, 1) if full else low)
        else:
            raise AssertionError(op)
    return out


SAMPLES = [(s, [_sample(_parser.parse(s[0]), full) for full in (False, True)]) for s in signatures()]


def test_there_are_hundreds_of_them():
    assert len({s[0] for s in signatures()}) >= 200 and len({s[1] for s in signatures()}) >= 80


@pytest.mark.parametrize("signature, samples", SAMPLES, ids=lambda x: x[0][:40] if isinstance(x, tuple) else "")
def test_keyword_trigger_and_near_miss(signature, samples):
    regex, _, keyword, _, _ = signature
    whole = rf"(?<= ){regex}(?= )"
    for text in samples:
        assert re.search(whole, f" {text} "), text
        assert keyword in text.split(), f"a match without its keyword: {text}"
        assert re.search(TRIGGER, text), f"a match that the trigger leaves out: {text}"
    words = samples[0].split()
    for miss in (words[:-1], words[1:], [*words[: len(words) // 2], "unrelated", *words[len(words) // 2 :]]):
        if ".{" not in regex:
            assert not re.search(whole, f" {' '.join(miss)} "), miss


def test_signatures_label_notices_that_do_not_name_their_license(frame):
    """Through the scan, wrapped over lines and comment signs."""
    gaps = [" ", "\n# ", "\r\n * ", ", "]
    rows, labels = [], {}
    for i, (signature, samples) in enumerate(SAMPLES):
        for j, text in enumerate(samples):
            rows.append((2 * i + j, "Some words before. " + text.replace(" ", gaps[i % 4]).upper() + gaps[i % 4] + "and after."))
            labels[2 * i + j] = (signature[1], signature[4])
    found = {r.doc_id: r for r in license_scan(frame(rows)).collect()}
    assert len(found) == len(rows)
    by_rule = {}
    for _, _, regex, label, priority, _ in signature_rules():
        by_rule.setdefault(label, []).append((regex, priority))
    for doc, (label, confidence) in labels.items():
        if label not in found[doc].labels.split(","):
            # A containing detection of better priority may stand in its place.
            assert found[doc].n_detections > 0 and found[doc].score >= confidence, (rows[doc], label)


def test_a_long_text_keeps_its_signatures(frame):
    text = "word " * 200_000 + "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"
    (row,) = license_scan(frame([(1, text)])).collect()
    assert row.labels == "bsd" and row.n_words == 200_018
