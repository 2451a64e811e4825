"""Small inputs and brute-force helpers of the document operator tests."""
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau "
         "upsilon phi chi psi omega über naïve façade 東京 data spark join").split()


def words(text):
    return WORDS.findall(text or "")


def prose(rng, n, vocab=VOCAB):
    return " ".join(rng.choice(vocab) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


def awkward_rows():
    """Null, empty, wordless, very short, very long, repeated and copied texts; null ids."""
    rng = random.Random(7)
    base = prose(rng, 120)
    long = prose(rng, 30_000)
    texts = [None, "", " \t\n ", "one", "two words", base, base, base.upper(), long, base + " and one more",
             base.replace("alpha", "ALPHA"), "a\n\n\nb\nb\nb", "x " * 400, prose(rng, 60), "1234 5678 !!! ??? " * 20]
    rows = [(i * 3 + 1, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, base, None, None, None), (None, None, None, None, None), rows[5], rows[8]]
    return rows


def frame(spark, rows=None, schema=SCHEMA):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, schema)


def noisy_copies(rng, n_base=12, copies=6, size=90):
    """Texts in groups of near copies: each copy has some words replaced."""
    out = []
    for _ in range(n_base):
        base = prose(rng, rng.randint(size // 2, size)).split()
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(VOCAB) + str(rng.randint(0, 99))
            out.append(" ".join(text))
    rng.shuffle(out)
    return out


def union_find(n):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def link(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return find, link
