from __future__ import annotations

import random
import re

from messy import empty, messy, messy_rows, prose

from tributary.llm import licenses

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
    return len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None, sorted({x for _, x in places})


def test_base_places_match_brute_force(spark):
    cases = ["MIT License", "the mit license mit license; MIT-License!", "admit license mit licensed", "cc by cc by cc",
             "GNU General\nPublic   License under the Apache License, CC BY 4.0", "", None, "mit", "license mit " * 40,
             "cc by-sa", "é mit license é", prose(1, 200) + " apache license"]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    for r in licenses.scan(docs).select("row.*", "res.*").collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(r.text), r.text
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1 and (r.score == 1) == (r.n_base > 0 or any(m.edits == 0 for m in r.matches))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_misspelt_notices_are_found_with_their_edits():
    scanner = licenses.Scanner()
    for notice in licenses.NOTICES:
        for cut in range(0, len(notice.text) - 1, 3):
            for wrong in (notice.text[:cut] + notice.text[cut + 1:], notice.text[:cut] + "q" + notice.text[cut + 1:],
                          notice.text[:cut] + "q" + notice.text[cut:]):
                text = f"some words before {wrong} and after"
                found = [m for m in scanner.near_matches(text) if m["label"] == notice.label]
                assert found, text
                best = min(found, key=lambda m: m["edits"])
                own = " ".join(text.split()[best["first_word"]:best["last_word"] + 1])
                assert best["edits"] <= max(n.edits for n in licenses.NOTICES if n.label == notice.label)
                assert any(edits(own, n.text) <= n.edits for n in licenses.NOTICES if n.label == notice.label)


def test_pieces_that_occur_twice_in_their_notice_do_not_hide_a_match():
    scanner = licenses.Scanner()
    found = scanner.near_matches("the work is licinsed undor thi apochi license version 2 0 and more")
    assert [(m["label"], m["first_word"], m["last_word"], m["edits"]) for m in found] == [("apache", 3, 10, 5)]
    rng = random.Random(4)
    for notice in licenses.NOTICES:
        for _ in range(60):
            wrong = list(notice.text)
            for at in rng.sample([i for i, c in enumerate(wrong) if c != " "], notice.edits):
                wrong[at] = "q"
            found = scanner.near_matches(f"license version {''.join(wrong)} the license")
            assert any(m["label"] == notice.label for m in found), wrong


def brute_matches(text):
    """All runs of words against all notices; of runs that share a word the best."""
    words, found = text.split(), {}
    for n in licenses.NOTICES:
        runs = []
        for a in range(len(words)):
            for b in range(a, len(words)):
                run = " ".join(words[a:b + 1])
                if len(run) > len(n.text) + n.edits:
                    break
                if len(run) >= len(n.text) - n.edits and (d := edits(run, n.text)) <= n.edits:
                    runs.append((d, a, b))
        taken = set()
        for d, a, b in sorted(runs):
            if not taken & set(range(a, b + 1)):
                taken |= set(range(a, b + 1))
                found[a, b, n.label] = min(found.get((a, b, n.label), (d, len(n.text))), (d, len(n.text)))
    return [(label, a, b, d) for (a, b, label), (d, _) in sorted(found.items())]


def near(text, scanner=licenses.Scanner()):
    return [(m["label"], m["first_word"], m["last_word"], m["edits"]) for m in scanner.near_matches(text)]


def test_neighbouring_notices_are_all_found():
    assert near("gnu general public licence gnu general public license gnu generl public license") == [
        ("gpl", 0, 3, 1), ("gpl", 4, 7, 0), ("gpl", 8, 11, 1)]
    mit = licenses.NOTICES[5].text
    assert near(f"{mit.replace('granted', 'grantd')} {mit}") == [("mit", 0, 12, 1), ("mit", 13, 25, 0)]
    rng = random.Random(6)
    for _ in range(25):
        parts = []
        for notice in rng.choices(licenses.NOTICES, k=3):
            wrong = list(notice.text)
            for _ in range(rng.randint(0, notice.edits + 1)):
                at = rng.randrange(len(wrong))
                wrong[at:at + rng.randint(0, 1)] = rng.choice(("", "q", "e", " "))
            parts.append("".join(wrong))
        text = " ".join(" ".join(rng.choices((*parts, *parts, "the", "license"), k=5)).split())
        assert near(text) == brute_matches(text), text


def test_pieces_cover_the_notice_and_clean_text_has_no_label():
    for notice in licenses.NOTICES:
        assert "".join(p for _, p in notice.pieces) == notice.text and len(notice.pieces) == notice.edits + 1
    scanner = licenses.Scanner()
    assert not any(scanner.near_matches(prose(i, 400)) for i in range(20))


def test_messy_documents(spark):
    rows = licenses.scan(messy(spark)).select("row.*", "res.*").drop("row").collect()
    assert len(rows) == len(messy_rows())
    by = sorted((str(r.doc_id), str(r[-8])) for r in licenses.scan(messy(spark), keep=["doc_id"]).select("row.doc_id", "res.*").collect())
    assert by == sorted((str(i), str(brute(t)[0])) for i, t, *_ in messy_rows())
    assert licenses.scan(empty(spark)).count() == 0


def test_regex_counts_the_fewest_edits():
    scanner, rng = licenses.Scanner(), random.Random(8)
    for n, notice in enumerate(licenses.NOTICES):
        for _ in range(120):
            wrong = list(notice.text)
            for _ in range(rng.randint(0, notice.edits + 2)):
                at = rng.randrange(len(wrong))
                wrong[at:at + rng.randint(0, 1)] = rng.choice(("", "q", "e", " ", "ic"))
            run = "".join(wrong)
            d = edits(run, notice.text)
            assert scanner.edits(n, run) == (d if d <= notice.edits else None), (run, notice.text)


def test_dense_texts_take_seconds():
    import time
    scanner, rng = licenses.Scanner(), random.Random(9)
    words = sorted({w for n in licenses.NOTICES for w in n.text.split()})
    began = time.time()
    assert near("license version permission " * 190_000, scanner) == []
    mixed = " ".join(rng.choice(words) for _ in range(60_000))
    scanner.near_matches(mixed)
    assert time.time() - began < 40
