"""Small document tables with awkward rows."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string"

WORDS = ("the and of a in is that was with on house river stone cloud paper glass window garden letter "
         "winter number école für niño straße").split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows(seed: int = 1, n: int = 40) -> list[tuple]:
    """Plain, empty, null, tied, repeated, long and near-copied texts; the
    last two columns clash with result columns."""
    rng = random.Random(seed)
    passage = sentence(rng, 70)
    texts = [sentence(rng, rng.randint(1, 160)) for _ in range(n)]
    texts[3] = texts[4] = texts[5]
    texts[6] = texts[7] + " " + passage
    texts[8] = passage + "\n" + texts[9] + "\t" + passage
    texts[10] = "a " * 300
    texts[11] = sentence(rng, 4000)
    texts[12] = texts[11][:9000] + " changed " + texts[11][9000:]
    texts[13] = "line one here\nline one here\n\n  \nline one here"
    texts[14:18] = ["", "   \n ", "12345 !!! ---", "x"]
    texts[18] = passage.upper()
    texts[19] = "é" * 120 + "中文" * 60
    texts[20] = texts[19] + " tail"
    out = [(i * 3, t, None if i % 7 == 0 else rng.choice(["en", "de"]), "s", len(t), "clash", "clash")
           for i, t in enumerate(texts)]
    out.append((1000, None, None, None, None, None, None))
    out.append((None, texts[11], "en", "s", 1, "x", "x"))
    out.append(out[5])  # a repeated row
    out.append((15, "another text under a used id " + passage, "en", "s", 1, "x", "x"))
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def by_row(df, *cols):
    """Sorted plain rows, nulls first."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
