"""Licence scan against a plain search."""

import random
import re

from trustlens.llm import license

from helpers import corpus, documents


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)


def places(words, phrase):
    phrase = phrase.split()
    return [i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase]


def plain(rows):
    """Every start of every template, by counting words in place."""
    texts = [words_of(t) for _, t, *_ in rows]
    sets = [set(w) for w in texts]
    vocabulary = {w for _, t, _ in license.TEMPLATES for w in t.split()}
    seen = {w: sum(w in s for s in sets) for w in vocabulary}
    out = []
    for (doc_id, *_), words, have in zip(rows, texts, sets):
        base = [(p, label) for phrase, label in license.BASE_PHRASES.items() for p in places(words, phrase)]
        found = []
        for label, text, mandatory in license.TEMPLATES:
            t = text.split()
            rare = sorted((w for w in set(t) if w in have), key=lambda w: (seen[w], w.encode()))[: license.RARE_WORDS]
            for s in range(-len(t) + 1, len(words)):
                at = [j for j in range(len(t)) if 0 <= s + j < len(words) and words[s + j] == t[j]]
                agree = {t[j] for j in at} & set(rare)
                inside = words[max(0, s) : s + len(t)]
                if len(agree) >= license.AGREE and len(at) / len(t) >= license.IN_PLACE and all(places(inside, m) for m in mandatory):
                    found.append((s, label, len(at) / len(t)))
        own = sorted(p for p, _ in base)
        labels = {x for _, x in base}
        out.append((
            doc_id, len(words), len(own), own[0] if own else None, own[-1] if own else None, ",".join(sorted(labels)),
            ",".join(sorted(labels | {x for _, x, _ in found})), 1.0 if own else max((s for *_, s in found), default=0.0), sorted((s, x) for s, x, _ in found),
        ))
    return out


def test_scan_equals_a_plain_search(spark):
    rng = random.Random(8)
    rows = [(i, t) for i, t in corpus(6, 30)]
    notices = [t for _, t, _ in license.TEMPLATES]
    for i, notice in enumerate(notices * 2):
        w = notice.split()
        for _ in range(rng.randint(0, 2)):  # a few words changed
            w[rng.randrange(len(w))] = rng.choice(["xyzzy", "the", "license"])
        cut = w[rng.randint(0, 2) :]
        rows.append((2000 + i, rng.choice(["", "x " * 5, "// "]) + ",\n# ".join(cut).upper() + rng.choice([".", " tail of text"])))
    rows += [
        (3000, "The MIT License, an MIT-license; mit  license"),
        (3001, "Apache License MIT License General Public License"),
        (3002, "mit.licensed mitlicense MIT Licenses general public"),
        (3003, notices[0] + " and " + notices[3] + " " + notices[0]),
        (3004, "license " * 5000 + notices[13]),
        (None, "Licensed under CC BY-NC 4.0."),
    ]
    got = license.scan_licenses(documents(spark, rows)).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    have = [(*r[:8], sorted((p.start, p.label) for p in r.places)) for r in got]
    assert sorted(have, key=lambda r: str(order(r))) == sorted(plain(rows), key=lambda r: str(order(r)))
    by_id = {r.doc_id: r for r in got}
    assert by_id[3000].n_base == 3 and by_id[3000].labels == "mit"
    assert by_id[3001].base_labels == "apache,gpl,mit" and (by_id[3001].first_word, by_id[3001].last_word) == (0, 4)
    assert by_id[3002].labels == "" and by_id[3002].score == 0
    assert by_id[3003].labels == "bsd,mit" and [p.start for p in by_id[3003].places] == [0, 30, 51]
    assert by_id[None].labels == "cc-by-nc" and by_id[None].score == 1.0


def test_own_templates(spark):
    rows = [(1, "do what you want with this code"), (2, "this code do what")]
    own = [("wtf", "do what you want with this", ["what you want"])]
    got = {r.doc_id: r for r in license.scan_licenses(documents(spark, rows), own, {"this code": "ours"}).collect()}
    assert (got[1].labels, got[1].base_labels, got[1].last_word) == ("ours,wtf", "ours", 5)
    assert got[2].labels == "ours"


def test_empty_table(spark):
    assert license.scan_licenses(documents(spark, [])).collect() == []
