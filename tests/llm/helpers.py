"""Documents with every odd case, and extra columns whose names operators use inside."""

import random

SCHEMA = "doc_id long, text string, source string, n_chars long, body string, key string, cls string, hash long, part int, start int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "src", None if t is None else len(t), "b", "k", "c", 1, 2, 3) for i, t in rows], SCHEMA)


def words(seed, n, size=400):
    random.seed(seed)
    vocabulary = ["".join(random.choice("abcdefghijklmnopqrstuvwxyzäé") for _ in range(random.randint(2, 9))) for _ in range(size)]
    return [random.choice(vocabulary) for _ in range(n)]


def odd_documents():
    """Nulls, empty texts, repeated rows and ids, ties, a very long text, groups of exact and near copies."""
    rows = [(1, "Hello World"), (2, "hello world"), (2, "hello world"), (3, None), (4, ""), (5, "   "), (None, "no id here"), (None, None),
            (6, "ÄB c"), (7, "äb C"), (8, "x"), (9, " ".join(words(1, 9000)))]
    rows += [(100 + k, "Many Copies of one text, seen again and again." if k % 2 else "many copies of ONE text, seen again and again.") for k in range(40)]
    base = words(2, 60)
    for k in range(30):
        copy = list(base)
        copy[k] = f"changed{k}"
        rows.append((200 + k, " ".join(copy)))
    lines = [" ".join(words(50 + k, 8)) for k in range(12)]
    for k in range(10):
        own = [" ".join(words(500 + 20 * k + j, 7)) for j in range(6)]
        rows.append((300 + k, "\n".join(own[:3] + lines + own[3:])))
    return rows
