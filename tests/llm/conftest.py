import pytest

pytest.importorskip("voxelframe.llm")

# null and repeated ids and texts, blank and wordless texts, repeated rows, a long text
LONG = " ".join(f"word{i % 97} x{i}" for i in range(30_000))
MESSY = [(1, "Alpha beta gamma delta."), (2, "alpha BETA gamma delta."), (3, None), (3, None), (4, ""), (5, " \t\n"), (6, "12 34 ... %%"),
         (None, "No id here, but words."), (None, None), (7, "Repeated row."), (7, "Repeated row."), (8, "Ünïcödé wörter ẞ über 東京 😀 alles."), (9, LONG), (9, "Same id, other text.")]

# null ids, turns, roles and texts, repeated rows, turns that share a number, gaps, control strings, odd roles, a long text
TALKS = [(0, 0, "system", "Be kind."), (0, 1, "user", "Hello?"), (0, 2, "assistant", "Yes."), (0, 3, "user", "Good."), (0, 4, "assistant", "Bye!"),
         (1, 0, "user", "Own."), (1, 1, "assistant", "No end"), (1, 1, "assistant", "No end"), (1, 5, "user", "\t \n"), (1, 9, "user", "Own."),
         (2, None, "user", None), (2, None, None, "x."), (2, 3, "tool", "\\\\ ### </turn>"), (2, 3, "a:b\\", "### Assistant: </turn>\n"), (2, 4, "", "\\"),
         (None, 1, "user", "No id."), (None, 1, "user", "No id."), (None, None, None, None), (3, None, "assistant", None), (107, 2, "assistant", LONG), (100, 0, "user", "Hello?"),
         (-205, 0, "user", "Minus."), (4, 0, "system", "Only a system turn."), *[(5, n, "ua"[n % 2] * 3, f"turn {n % 7}.") for n in range(40)]]


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with every kind of odd row, and extra columns named like those the operators use inside."""
    names = ["uid", "id", "fp", "word", "size", "row", "term", "part", "cell", "__k1", "h", "w", "task", "key", "bin"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names)
    rows = [(i, t, None if n % 5 == 0 else "xx", None, None, *[None if n % 2 else n] * len(names)) for n, (i, t) in enumerate(MESSY)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def folder(spark, messy, tmp_path_factory):
    """Folders of the tables: messy rows, and no rows at all."""
    import numpy as np

    top = tmp_path_factory.mktemp("tables")
    tables = {
        "documents": messy,
        "benchmark": spark.createDataFrame([(1, "gamma delta"), (2, None), (None, "gamma DELTA!"), (3, ""), (4, "absent words only"), (1, "gamma delta")], "item_id long, text string"),
        "embeddings": spark.createDataFrame([(i, None if i == 3 else [0.0, 0.0] if i == 4 else [1.0, None] if i == 5 else [1.0, float("nan")] if i == 6 else
                                              [float(x) for x in np.random.default_rng(i % 7).normal(size=2)], 0) for i in [*range(30), 20]] + [(None, [1.0, 2.0], 0), (77, [1.0, 2.0, 3.0], 0)],
                                            "vec_id long, embedding array<float>, label int"),
        "conversations": spark.createDataFrame([(*t, None, n, "x", None) for n, t in enumerate(TALKS)], "conv_id long, turn long, role string, text string, part long, tie long, path string, `end` binary"),
        "pages": spark.createDataFrame([(1, "http://a/", "<p>x</p>"), (2, None, None), (2, None, None), (None, "u", "")], "page_id long, url string, html string"),
    }
    for name, df in tables.items():
        df.write.parquet(str(top / "messy" / f"{name}.parquet"))
        df.limit(0).write.parquet(str(top / "none" / f"{name}.parquet"))
    return {"messy": str(top / "messy"), "none": str(top / "none")}


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}
