"""Sign lists in each shape, against rows read by hand."""

from strandgraph.sources import signlists


def rows(df):
    return sorted((r.reading, r.sign) for r in df.collect())


def as_is(reading):
    return reading


def put(path, text):
    path.write_text(text, encoding="utf8")
    return str(path)


def test_pairs(spark, tmp_path):
    quoted = put(tmp_path / "a", '# head\n"a2": "𒀀"  # x\n  "szu": 𒋗\n"no": "??"\n"a2": 𒀀\nbad\n"e":\n\n')
    assert rows(signlists.quoted_pairs(spark, quoted, "q")) == [("a₂", "𒀀"), ("šu", "𒋗")]
    tabs = put(tmp_path / "b", "a\t𒀀\nno tab\n(4×za)×kur\tx\n1(asz)\t𒀸\n\ty\nz\t\nb\tc\td\n")
    assert rows(signlists.tab_pairs(spark, tabs, "t", spelling=as_is)) == [("a", "𒀀"), ("b", "c\td")]
    assert signlists.tab_pairs(spark, put(tmp_path / "c", ""), "t").count() == 0


def test_bracketed_names(spark, tmp_path):
    path = put(tmp_path / "a", '𒀀,1,"AN (1, ANA3, A\n (see: U.DAR (nos. 670+183)), B: see C, two words)"\n𒁀,2,BA\n𒂀,3,"E (F, G (open, H"\n,4,X\n𒃀\n𒄀,5,"averyverylongnameindeed"\n')
    want = [("1", "𒀀"), ("A", "𒀀"), ("AN", "𒀀"), ("ANA3", "𒀀"), ("B", "𒀀"), ("BA", "𒁀"), ("E", "𒂀"), ("F", "𒂀"), ("G", "𒂀")]
    assert rows(signlists.bracketed_names(spark, path, "n", spelling=as_is)) == want


def test_blocks(spark, tmp_path):
    text = "@head x\n@v lost\n@sign A\n@list\tHZL007\n@list MZL9\n@v\ta\n@v %akk b\n@v aš/dil\n@v c?\n@v -d\n@form B\n@ucun form\n@v f\n@end sign\n@v outside\n"
    text += "@sign C \r\n@ucun\t𒀀\r\n@ucun second\n@list HZL7a\n@sign D\n@ucun 𒁀\n@list HZL7\n@form x\n@ucun 𒂀\n@end sign\n"
    path = put(tmp_path / "a", text)
    listed = signlists.blocks(spark, path, "HZL")
    got = {r.name: (r.sign, sorted(r.readings), r.numbers) for r in listed.collect()}
    assert got == {"A": (None, ["a", "akk", "aš", "c", "f"], ["7"]), "C": ("𒀀", [], ["7"]), "D": ("𒁀", [], ["7"])}
    assert rows(signlists.block_readings(spark, path, "b", spelling=as_is)) == [("C", "𒀀"), ("D", "𒁀")]
    assert sorted((r.sign, r.other) for r in signlists.same_number(listed).collect()) == [("𒀀", "𒀀"), ("𒀀", "𒁀"), ("𒁀", "𒀀"), ("𒁀", "𒁀")]
