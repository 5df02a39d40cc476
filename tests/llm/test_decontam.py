import random
import re

from vellum.llm.decontam import contained, remove_contaminated


def brute(docs, items):
    def spell(t):
        return re.sub(r"[\W_]+", " ", (t or "").lower()).split()

    seen, out = {}, {}
    for i, t in sorted(items):
        if spell(t):
            seen.setdefault(tuple(spell(t)), i)
    for w, i in seen.items():
        k = min(5, len(w))
        own = {w[j : j + k] for j in range(len(w) - k + 1)}
        for d, t in docs:
            v = tuple(spell(t))
            n = len(own & {v[j : j + k] for j in range(len(v) - k + 1)})
            if d is not None and n >= 0.8 * len(own) - 1e-9:
                out[d, i] = (n, len(own))
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 4, 5, 9, 20, 33, 60])))) for i in range(30)]
    items += [(90, items[0][1].upper() + "!"), (91, None), (92, ""), (93, "...")]
    docs = []
    for i in range(120):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 2, 30, 400]))]
        for _ in range(rng.choice([0, 1, 2])):
            own = rng.choice(items)[1]
            own = (own or "").split()
            if own and rng.random() < 0.5:
                own[rng.randrange(len(own))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
        docs.append((i, ", ".join(words)))
    docs += [(500, None), (501, ""), (None, items[0][1]), (502, items[10][1] + " " + " ".join(vocab * 50))]
    got = contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in got} == want and len(got) == len(want) and len(want) > 20
    kept = remove_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, _ in docs if d is not None and d not in {x for x, _ in want}), key=str)  # the row without an id is judged too


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contained(docs, items.limit(0)).collect() == []
    assert contained(docs.limit(0), items).collect() == []
    assert contained(docs, items).first().containment == 1.0
