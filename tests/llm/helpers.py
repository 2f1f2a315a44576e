"""Small tables with everything awkward in them."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, kept string, copies int"
SPACE = "[^\x20\x09-\x0d]+"


def words(text):
    return re.findall(SPACE, text or "")


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); the other columns clash with
    names that the operators use themselves."""
    full = [(*r, *[None] * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(i, t, la, so, len(t or ""), "x", "y", "z", 7) for i, t, la, so in full], SCHEMA)


def corpus(seed=3, n=60):
    """Texts with exact and near copies, shared passages, null and odd rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Élan", "straße", "naïve"]
    sentence = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = sentence(50)
    out = []
    for i in range(n):
        lines = [sentence(rng.randint(3, 15)) for _ in range(rng.randint(1, 12))]
        if i % 5 == 0:
            lines.insert(rng.randint(0, len(lines)), passage)
        out.append("\n".join(lines))
    for i in range(0, n, 6):
        out.append(out[i])
    for i in range(0, n, 7):
        changed = out[i].split(" ")
        changed[len(changed) // 2] = "changed"
        out.append(" ".join(changed))
    rows = [(i * 3, t) for i, t in enumerate(out)]
    rows += [(1, None), (2, ""), (4, " \t\n "), (5, "one"), (7, "ONE"), (8, "a b c d"), (10, "A b c D"), (None, out[0]), (None, "alone in the world is this text here")]
    rows += [(rows[3][0], rows[3][1])]  # a repeated row
    rows.append((11, "again and " * 2000 + sentence(3000)))
    return rows
