"""Small inputs with every awkward case, and brute-force versions of the word and set rules."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Extra columns carry names that operators use inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("k", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("t", T.IntegerType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("node", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("_key", T.StringType()),
        T.StructField("_row", T.StringType()),
    ]
)


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, alphabet=40):
    stems = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(rng.randint(1, 7))) for _ in range(alphabet)]
    return [rng.choice(stems).capitalize() if i % 11 == 0 else rng.choice(stems) for i in range(n)]


def texts(seed=5):
    """(doc_id, text, source): nulls, blanks, ties, copies, near copies, shared passages, one very long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(30, 120)) for _ in range(12)]
    passage = prose(rng, 60)
    rows = []
    for i, w in enumerate(base):
        rows.append(" ".join(w[:5]) + "\n" + " ".join(w[5:]))
    for w in base[:6]:
        near = list(w)
        near[rng.randrange(len(near))] = "changed"
        rows.append(" ".join(near))
    rows += [" ".join(base[0]), " ".join(base[0]).upper(), " ".join(base[0]) + " "]
    for w in base[6:10]:
        rows.append(" ".join(w[:20] + passage + w[20:]))
    rows += ["", " \t\n", "one", "two words", "a b c", "a b c", "ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha " * 20]
    rows += ["| x | y | z |\n" * 30, "é" * 250 + " " + "é" * 250, " no break space 🙂 ▁mark\x00nul"]
    rows += [" ".join(prose(rng, 9000, 400)), "Copyright line\nbody " + " ".join(base[11]), None]
    out = [(i, t, f"s{i % 4}" if i % 9 else None) for i, t in enumerate(rows)]
    out.append((3, rows[3], "s3"))  # a repeated row
    out.append((4, "another text under a used id " + rows[4], "s0"))
    out.append((None, rows[1], "s1"))
    out.append((None, None, None))
    return out


def frame(spark, rows):
    full = [(i, t, "en", s, len(t or ""), "x", "y", 1, 2, "z", "r", "u", "v") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, n):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def sort_key(row):
    return tuple((x is not None, x) for x in row)


def collected(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=sort_key)
