"""Plain Python versions that results are compared with."""

from collections import Counter, defaultdict

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=""):
    """A documents table from (doc_id, text) pairs."""
    full = [(i, t, "en", "src0", len(t) if t is not None else None) + (("x",) if extra else ()) for i, t in rows]
    return spark.createDataFrame(full, DOC + (f", {extra} string" if extra else ""))


def sample(spark, sf_dir, n):
    """The first documents of a table as (doc_id, text) pairs."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where(f"doc_id < {n}").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


def smallest_reachable(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def similar_pairs(sets, limit):
    """Pairs of keys whose sets have a Jaccard similarity of ``limit`` (in percent) or more."""
    where = defaultdict(list)
    for key, s in sets.items():
        for x in s:
            where[x].append(key)
    common = Counter()
    for keys in where.values():
        for i, a in enumerate(keys):
            for b in keys[i + 1:]:
                common[(a, b)] += 1
    return [(a, b) for (a, b), n in common.items()
            if 100 * n >= limit * (len(sets[a]) + len(sets[b]) - n)]


def word_shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))
