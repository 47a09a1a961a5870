import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with nulls, empties, ties, repeats and clashing extra columns."""
    long = " ".join(f"w{i % 97}x{i}" for i in range(4000))
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta", "en"), (2, "alpha BETA gamma delta epsilon zeta", None),
        (3, None, "fr"), (4, "", "fr"), (5, long, "de"), (6, long + " tail", "de"), (7, "Éa é", None),
        (8, "   ", "x"), (9, "éa É", "x"), (10, "Alpha beta gamma delta epsilon zeta", "en"),
        (10, "Alpha beta gamma delta epsilon zeta", "en"), (11, "a\nb\n\nc", "x"), (12, "\U0001f600 <|endoftext|> x  y\t\tz", "x"),
    ]
    # the extra columns have names that the operators use inside
    return spark.createDataFrame(
        [(i, t, g, 1.5, "d", 7) for i, t, g in rows], "doc_id long, text string, lang string, score double, deleted string, n_chars long")


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("doc_id < 0")


def brute_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_components(rows):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = brute_words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(sets[i]), label[i]) for i in ids}
