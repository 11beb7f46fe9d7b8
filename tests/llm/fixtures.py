"""Small tables with the hard cases: nulls, empty and long texts, repeated rows, clashing names."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, node string, length long, h int, shard string"
SPACES = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return SPACES.findall(text or "")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=5):
    w = words(fold(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def texts(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "the", "AND", "don't", "3.14", "日本語テキスト", "é"]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = prose(60), prose(30)
    out = [base, base, base + " tail", "head " + base, base.upper(), prose(40) + " " + passage + " " + prose(20),
           passage, prose(10) + "\n" + passage + "\n" + prose(10), "", None, " \t\n ", "one", "one two three", "one two three",
           "a " * 100, "a " * 70 + "b " * 30, "b " * 40, "x y " * 60, "x y " * 45 + "z", "   odd spaces  \n\n  x", "tab\tand\x0bvertical\x0cfeed\r\n",
           "<|endoftext|> inside", prose(6000), "long" * 3000, prose(25)]
    for i in range(25):
        w = base.split()
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"new{i}"
        out.append(" ".join(w))
    out += ["\n".join(prose(4) for _ in range(6)) for _ in range(5)]
    return out


def rows(seed=1):
    out = [(i * 7 % 101, t, "en", f"src{i % 3}" if i % 5 else None, len(t) if t is not None else None, "k", "n", 5, 1, "s")
           for i, t in enumerate(texts(seed))]
    return out + [out[0], out[0], (None, out[0][1], None, None, None, None, None, None, None, None), (None, None, None, "src1", 0, None, None, None, None, None),
                  (out[3][0], "same id other text here now", "en", "src0", 1, "k", "n", 1, 1, "s")]


def table(spark, seed=1, parts=3):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
