"""Later copies of short lines and of paragraphs in scripts without spaces."""

from bandlore.llm import repeats as M


def left(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in M.without_repeats(docs).orderBy("doc_id").collect()]


def test_later_copies_of_lines_go(spark):
    line, han = "Subscribe to our letter and never miss a thing", "".join(chr(c) for c in range(0x4e00, 0x4ff4))
    texts = [f"One begins here.\n{line}\nOk then\n{han}", f"Other words stand first.\n{line}\nand more below\nOk then",
             f"Third.\nIs it {line} or not?\n{han}\nOk then\nlast words"]
    assert left(spark, texts) == [texts[0], "Other words stand first.\n\nand more below\n",
                                  f"Third.\nIs it {line} or not?\n\nlast words"]


def test_fragments_of_scripts_without_spaces(spark):
    """A sentence among others of one line goes by its letters."""
    shared = "这些句子在许多文件中一再出现没有空格也没有换行所以只能按照字母来计算它们的长度而不是按照单词数目. "
    texts = [f"甲乙丙丁戊己庚辛. {shared}子丑寅卯辰巳午未.", f"春夏秋冬东西南北. {shared}金木水火土日月星."]
    assert left(spark, texts)[1] == "春夏秋冬东西南北.  金木水火土日月星."
