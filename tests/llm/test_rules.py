"""Line rules: base counts against plain Python, verdicts on known lines."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from armature.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    mark = [False] * len(words)
    for i in range(len(words) - 4):
        if seen[tuple(words[i : i + 5])] > 1:
            mark[i : i + 5] = [True] * 5
    n, again = len(words), sum(mark)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), again, n < 10 or 100 * again > 20 * n


def made():
    rng = random.Random(2)
    bits = ["a", "b", "cé", "#x", "\n", "\n", " \n", "  ", "\t", "\v", "|", "日本", "a.", " ", "\x1c", "<p>"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(0, 120))) for _ in range(400)]
    return [*texts, None, "", "\n\n", "one two three four five " * 3000, "x" * 100_000]


def test_counts_equal_plain_python(spark):
    texts = made()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in rules.apply_rules(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(texts[r.doc_id]), repr(texts[r.doc_id])[:200]


GOOD = "A sentence with a few words stands here. Another one follows it, and ends well."
BAD = {
    "navigation": "Home | News | Sport | Weather | Travel | More",
    "symbols": "buy### now*** at$$$ best%%% price&&& ever###",
    "capitals": "BUY!! NOW!! THE!! BEST!! PRICE!! EVER!!",
    "boilerplate": "We use cookies to make this site work. Read our privacy policy.",
    "short": "Menu",
    "unended": " ".join(["word"] * 80),
}


def test_lines_that_break_a_rule_go(spark):
    docs = spark.createDataFrame([(k, f"{GOOD}\n{v}\n{GOOD} It is over.") for k, v in BAD.items()], "doc_id string, text string")
    for r in rules.apply_rules(docs).collect():
        assert r.n_removed_lines == 1 and r.clean_text == f"{GOOD}\n{GOOD} It is over.", r


def test_lines_without_an_end_go_unless_they_are_wrapped(spark):
    menu = "Home Products About us Contact"
    wrapped = "A long sentence that was cut by its writer at\nEaster and goes on here\nwith a few more words, and ends."
    texts = {1: f"{GOOD}\n\n{menu}\n\n{wrapped}", 2: f"{menu} Help\n{menu} News\n{menu} Jobs", 3: wrapped, 4: f"{GOOD} It goes on\nover the line without an end"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in rules.apply_rules(docs).collect()}
    assert found[1].n_removed_lines == 1 and found[1].clean_text == f"{GOOD}\n\n\n{wrapped}" and found[1].kept
    assert found[2].n_removed_lines == 3 and not found[2].kept
    assert found[3].n_removed_lines == 0 and found[3].kept
    assert found[4].clean_text == f"{GOOD} It goes on\n"


def test_documents_that_lose_too_much_go(spark):
    bad = BAD["navigation"]
    docs = spark.createDataFrame([(1, f"{GOOD}\n{bad}"), (2, f"{GOOD}\n" + "\n".join(f"{bad} | {i}" for i in range(9))), (3, GOOD)], "doc_id long, text string")
    found = {r.doc_id: r for r in rules.apply_rules(docs).collect()}
    assert found[1].kept and not found[2].kept and found[3].kept
    assert found[2].clean_text == GOOD + "\n" and found[3].clean_text == GOOD and found[3].lost_share == 0


def test_clashing_columns_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (2, "")], "doc_id long, text string").withColumn("kept", F.lit("mine")).withColumn("other", F.lit(1))
    found = rules.apply_rules(docs)
    assert found.columns.count("kept") == 1 and "other" in found.columns
    assert [(r.n_words, r.kept, r.clean_text) for r in found.collect()] == [(0, False, "")] * 3
    assert rules.apply_rules(docs.limit(0)).count() == 0


SCRIPTS = {
    "hi": "यह एक अच्छा वाक्य है जो यहाँ लिखा गया है। दूसरा वाक्य भी यहीं समाप्त होता है।",
    "ur": "یہ ایک اچھا جملہ ہے جو یہاں لکھا گیا ہے۔ دوسرا جملہ بھی یہیں ختم ہوتا ہے۔",
    "ar": "هل هذه جملة جيدة كتبت هنا من أجل هذا الاختبار الصغير اليوم؟",
    "hy": "Սա լավ նախադասություն է, որը գրված է այստեղ այս փորձի համար։",
    "th": "นี่คือประโยคที่ดี ซึ่งเขียนไว้ที่นี่ เพื่อการทดสอบ ครั้งนี้ และ ไม่มี เครื่องหมาย ใด ๆ เลย ใน ข้อความ",
    "am": "ይህ ጥሩ ዓረፍተ ነገር ነው እዚህ ለዚህ ትንሽ ሙከራ የተጻፈ ነው። ሌላም አለ።",
    "km": "នេះ គឺ ជា ប្រយោគ ល្អ មួយ ដែល បាន សរសេរ នៅ ទីនេះ សម្រាប់ ការ សាកល្បង។",
    "my": "ဒါ က ဒီ စမ်းသပ်မှု အတွက် ဒီမှာ ရေးထား တဲ့ ဝါကျ ကောင်း တစ်ခု ပါ။",
    "ru": "Это хорошее предложение, которое написано здесь для этой проверки. И ещё одно.",
    "el": "Αυτή είναι μια καλή πρόταση που γράφτηκε εδώ για αυτή τη δοκιμή. Και άλλη μία;",
    "bn": "এটি একটি ভালো বাক্য যা এখানে এই পরীক্ষার জন্য লেখা হয়েছে। আরেকটি আছে।",
    "ta": "இது இந்த சோதனைக்காக இங்கே எழுதப்பட்ட ஒரு நல்ல வாக்கியம் ஆகும் என்று நான் நினைக்கிறேன்.",
    "bo": "འདི ནི ཚིག གྲུབ ཡག པོ ཞིག རེད། ཚོད ལྟ འདིའི ཆེད དུ བྲིས པ ཡིན།",
    "he": "זהו משפט טוב שנכתב כאן לצורך הבדיקה הקטנה הזאת של היום. ויש עוד אחד.",
    "zh": "今天 天气 很好。我们 一起 去 公园 散步，看 花，喝 茶，聊 天。然后 回家。",
    "vi": "Đây là một câu hay được viết ở đây cho phép thử nhỏ này. Và còn một câu nữa.",
    "colon": "These are the things that everybody has to bring along to the meeting tomorrow:",
}
VERSE = "the rain came down upon the hill\nand all the little birds were still\nand nobody could hear them sing\nuntil the sun came back in spring"


def test_prose_of_every_script_and_verse_stay(spark):
    texts = [*SCRIPTS.items(), ("verse", VERSE), ("stanzas", f"{VERSE}\n\n{VERSE.replace('rain', 'snow').replace('hill', 'mill')}")]
    docs = spark.createDataFrame(texts, "doc_id string, text string")
    for r in rules.apply_rules(docs).collect():
        assert r.n_removed_lines == 0 and (r.kept or r.base_failed), r
    kept = {r.doc_id for r in rules.apply_rules(docs).filter("kept").collect()}
    assert {"hi", "ur", "ar", "hy", "th", "ru", "el", "he", "vi", "colon", "verse"} <= kept


def test_one_rule_for_all_lengths(spark):
    some = "Here is one sentence. "
    texts = {n: some * n + " ".join(["word"] * (5 * n)) for n in (2, 10, 40)}  # under half of it ends
    texts |= {100 + n: some * (2 * n) + " ".join(["word"] * n) for n in (2, 10, 40)}
    marked = "यह अच्छा वाक्य है।\n\nसमाचार खेल मौसम यात्रा और अधिक पढ़ें"  # the script shows a mark here, so the menu goes
    docs = spark.createDataFrame([*((k, v) for k, v in texts.items()), (0, marked)], "doc_id long, text string")
    found = {r.doc_id: r.n_removed_lines for r in rules.apply_rules(docs).collect()}
    assert [found[n] for n in (2, 10, 40)] == [1, 1, 1] and [found[100 + n] for n in (2, 10, 40)] == [0, 0, 0] and found[0] == 1
