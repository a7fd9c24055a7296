from backsight.llm import licences

GPL, MIT = licences.TEMPLATES["GPL-3.0"][0], licences.TEMPLATES["MIT"][0]


def test_own_and_inherited(spark):
    rows = [
        ("a/LICENSE", MIT),
        ("a/b/c/x.txt", "nothing here"),
        ("a/b/COPYING", f"notes\n{GPL}\nmore"),
        ("a/b/y.txt", f"prose\n  {MIT.upper()}  "),
        ("z.txt", "no licence, only the word"),
        ("q/LICENSE.md", "empty words"),
        ("q/r.txt", None),
        (None, GPL),
        ("a/b/c/x.txt", "nothing here"),
        ("ab/x.txt", ""),
    ]
    files = spark.createDataFrame([(*r, "clash") for r in rows], "path string, text string, licence string").repartition(3)
    found = sorted((r.path or "", r.own_licence or "", r.licence or "", r.licensed_by) for r in licences.scan(files).collect())
    assert found == sorted(
        [
            ("a/LICENSE", "MIT", "MIT", None), ("a/b/c/x.txt", "", "GPL-3.0", "a/b/"), ("a/b/c/x.txt", "", "GPL-3.0", "a/b/"),
            ("a/b/COPYING", "GPL-3.0", "GPL-3.0", None), ("a/b/y.txt", "MIT", "MIT", None), ("z.txt", "", "", None),
            ("q/LICENSE.md", "", "", None), ("q/r.txt", "", "", None), ("", "GPL-3.0", "GPL-3.0", None), ("ab/x.txt", "", "", None),
        ]
    )


def test_every_notice_is_its_own_licence(spark):
    rows = [(f"{name}-{k}", text) for name, texts in licences.TEMPLATES.items() for k, text in enumerate(texts)]
    found = {r.path: r.own_licence for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert all(path.startswith(f"{name}-") for path, name in found.items() if name) and sum(v is not None for v in found.values()) >= len(rows) - 2


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], "path string, text string")).collect() == []
