"""Problem 10: template residue, filler, error pages and script notices.

Method: every document gives views, its whole text and each of its lines; views of equal
normalised words are one class, with a 64-bit SimHash over its five-word shingles. Trusted
labels are few and strict: a class is trusted where a document consists of nothing but
notices, error messages or filler phrases (its lines and its whole text are then residue),
or, for messages no document consists of, where a line does so in a document without
content. From the trusted classes near-duplicates are found through partitioned SimHash tables (band
of the hash plus a length bucket), verified by Hamming distance and by the Jaccard
similarity of the shingle sets (0.8 or more), and the label is propagated until no class is
added, which labels exactly the connected components that hold a trusted class. A document
is residue where its whole text has the label, or where its labelled lines leave no more
than a title or menu around them. So a notice under a title, in another page's frame or
with another number in it comes by its links and by no rule of its own.

Unfilled placeholders and runs of dummy words label their own document only: a
near-duplicate with the slot filled is real content. Slot names are learned: a name inside
single brackets or braces counts as a placeholder only if the corpus also uses it inside
unmistakable placeholder marks.

Cost at scale: one pass hashes all views of a batch together; equal views collapse before
they are joined, so a line that a third of the rows share is one class; candidates start
from labelled classes only and share a length bucket with them, so their number follows the
residue and not the square of the corpus; nothing is collected but one count and the range
of lengths per round.

Defined results: null, empty and blank texts are never found and stay in the clean corpus;
views of fewer than five words have one shingle of all their words, those of none have no
class; every repeated row is found; very long texts are read whole; extra columns are kept
by ``without_residue``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..runtime import materialise

WORDS_PER_SHINGLE = 5
MIN_SIMILARITY = 0.8
BANDS, BAND_BITS = 32, 14
MAX_HAMMING = 20
#: How a view is trusted: its document is nothing but residue, or its line is.
LINE, WHOLE = 1, 2

_NAME = r"[A-Za-z][A-Za-z_]*(?:\.[A-Za-z_]+)*"
#: Marks that nothing but a template uses; group 1.. hold the slot's name.
_SURE = [
    rf"(?<!\$)\{{\{{\s*({_NAME})\s*\}}\}}(?!\$)",
    rf"#\{{({_NAME})\}}",
    rf"(?<!\$)\$\{{({_NAME})\}}(?![$_^])",
    rf"<<({_NAME})>>",
    rf"\[\[({_NAME})\]\]",
    rf"@@({_NAME})@@",
    rf"\{{%-?\s*({_NAME})\s*-?%\}}",
    rf"<%[=-]?\s*({_NAME})\s*-?%>",
    rf"(?<![\w%])%({_NAME})%(?![\w%])",
    rf"(?<!\w)__(?!(?:init|name|main|file|doc|class|all|version)__)([A-Za-z][A-Za-z_.]*?)__(?!\w)",
    r"\[\s*insert\s+([^\[\]\n]{1,60}?)(?:\s+here)?\s*\]",
    r"<\s*insert\s+([^<>\n]{1,60}?)(?:\s+here)?\s*>",
    r"\[\s*(?:TODO|FIXME|TBD)\b:?\s*(?:add\s+)?([^\[\]]{0,80})\]",
    r"\[\s*insert\s+([^\[\]]{1,60}?)\s*\]",
]
#: Marks that formulas, citations and code use too.
_UNSURE = [rf"(?<![\[\w\\])\[({_NAME})\](?!\])", rf"(?<![{{#$\\A-Za-z_^%])\{{({_NAME})\}}(?!\}})"]

# The usual dummy Latin of layout programs, without words that living languages use often.
_DUMMY = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam nostrud exercitation "
    "ullamco laboris nisi aliquip commodo consequat aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat "
    "cupidatat proident culpa officia deserunt mollit anim laborum vitae porta mollis sapien metus ligula turpis lacus felis mauris pellentesque vestibulum "
    "viverra feugiat euismod ultrices ornare tortor vulputate volutpat pharetra convallis dapibus lectus"
).split()
_DUMMY_RUN = r"(?i)(?:\b(?:" + "|".join(_DUMMY) + r")\b[\s,.;]*){3,}"

#: Filler phrases of layout templates.
_FILLER = [
    r"\b(?:sample|dummy|placeholder|filler) (?:text|content|copy)\b", r"\b(?:text|copy|abstract|content|title|summary|caption)\b.{0,20}\bgoes here\b", r"\btype your .{1,40} here\b",
    r"\bclick to (?:add|edit)\b", r"\bbody copy to follow\b", r"\breplace this (?:paragraph|text|sentence|section)\b", r"\btest document used to\b", r"\bhier steht (?:ihr|der|dein) text\b",
    r"\b(?:votre texte ici|saisissez votre texte|texte à remplacer)\b", r"\b(?:su texto aquí|escriba aquí|texto de ejemplo)\b", r"(?:введите текст|текст-заполнитель|здесь будет текст)",
    r"此处(?:填写|输入)|占位文本", r"ここに.{0,12}(?:入力|記入)|ダミーテキスト", r"여기에.{0,12}입력|예시 텍스트", r"اكتب (?:النص|هنا)|نص تجريبي", r"यहाँ.{0,14}लिखें|नमूना पाठ",
    r"^\W*(?:tbd|todo|tba|n\.?n\.?)\W*$", r"^(?:heading|title|section|caption|text) \d+$", r"\b(?:asdf|qwer|jkl|foo bar|blah blah)\b", r"^[x.\s]*x{3,}[x.\s]*$",
]
#: Error messages and notices that scripts are required, in the corpus's languages.
_NOTICE = [
    r"\b(?:enable|activate|allow|turn on|switch on|requires?|needs?|support|without)\b.{0,40}\b(?:javascript|scripts?)\b(?!, while)", r"\b(?:javascript|scripts?)\b.{0,60}\b(?:disabled|required|enabled|allowed|blocked|turned off|must be)\b",
    r"\bsupport javascript\b", r"javascript.{0,40}(?:aktivieren|einschalten|activer|activez|activar|active|habilite|включите|有効|启用|開啟|활성화|허용|تفعيل|सक्षम)", r"(?:aktivieren|activer|activez|activar|active|habilite|включите|启用|請啟用|قم بتفعيل|يرجى تفعيل).{0,40}javascript",
    r"</?(?:html|head|body|noscript|title|h1)>", r"^\W*(?:error\s*)?(?:4\d\d|50\d)\b\W*(?:not found|forbidden|unauthorized|bad gateway|service unavailable|internal server error|gateway time-?out|too many requests|error)\b",
    r"^\W*error \d{3}\b", r"\binternal (?:server )?error\b", r"\b(?:access|permission) denied\b", r"\byou do not have permission\b", r"\b(?:page|document|article|file)\b.{0,50}\b(?:could not be found|was not found|not available at this time|no longer exists|has moved|does not exist|cannot be displayed)\b",
    r"\bsession has expired\b", r"\bsign in (?:again )?to\b", r"\btoo many requests\b", r"\b(?:wait|try again in) \d+ (?:seconds|minutes|hours)\b", r"\b(?:down|closed|unavailable)\b.{0,20}\bmaintenance\b", r"\bchecking your browser\b", r"\brequest id\b|\breference code:", r"\bsomething went wrong\b",
    r"\bloading (?:full text|page|content)\b", r"\breload the page\b", r"\bviewer requires\b", r"\btraceback \(most recent call last\)", r"^\s*file \".{1,80}\", line \d+", r"^\s*\w*(?:error|exception):", r"\b\w+(?:\.\w+)+exception\b", r"^\s*at [\w.$]+\(.{0,60}\)", r"\bnull (?:reference|pointer)\b",
    r"seite (?:wurde )?nicht gefunden|zugriff verweigert|existiert nicht mehr|bitte melden sie sich an|sitzung ist abgelaufen|anfragen von ihrer", r"page introuvable|accès refusé|n[’']existe plus|session a expiré|veuillez vous connecter", r"página no encontrada|acceso denegado|ya no existe|sesión ha (?:caducado|expirado)|inicie sesión",
    r"страница не найдена|доступ (?:запрещ[её]н|закрыт)|(?:статья|страница) удалена|ошибка сервера|сеанс истёк", r"页面不存在|找不到(?:页面|网页)|返回首页|服务器(?:繁忙|错误)|稍后再试|访问被拒绝|请登录", r"ページが見つかりません|urlを確認|アクセスが拒否|サーバーエラー|ログインしてください|セッションが",
    r"페이지를 찾을 수 없|접근이 거부|액세스가 거부|서버 오류|다시 로그인", r"الصفحة غير موجودة|لم يتم العثور|تم رفض الوصول|خطأ في الخادم", r"पृष्ठ नहीं मिला|पहुँच अस्वीकृत|सर्वर त्रुटि",
]


# What every notice or filler phrase above has at least one of, lower case.
_CUES = (
    "script|error|not found|forbidden|unauthorized|bad gateway|unavailable|too many requests|denied|permission|no longer exists|has moved|does not exist|could not be found|"
    "was not found|not available|cannot be displayed|expired|sign in|wait |try again|maintenance|browser|request id|reference code|went wrong|loading|reload|viewer|traceback|"
    "file \"|exception|at |null |html>|head>|body>|title>|h1>|time-out|timeout|nicht gefunden|verweigert|existiert nicht mehr|melden sie|abgelaufen|anfragen von|introuvable|"
    "accès refusé|existe plus|expiré|vous connecter|no encontrada|denegado|ya no existe|caducado|expirado|inicie|не найдена|запрещ|закрыт|удалена|ошибка сервера|сеанс|页面|网页|首页|"
    "服务器|稍后|访问被|请登录|見つかりません|urlを確認|アクセスが|サーバーエラー|ログイン|セッション|찾을 수 없|거부|서버 오류|로그인|الصفحة|العثور|الوصول|الخادم|पृष्ठ|अस्वीकृत|सर्वर|"
    "text|dummy|placeholder|filler|goes here|type your|click to|body copy|replace this|test document|texte|texto|escriba|введите|здесь будет|此处|占位|ここに|ダミー|여기에|예시|اكتب|تجريبي|"
    "यहाँ|नमूना|sample content|sample copy|заполнитель|nn|tbd|todo|tba|n.n|heading |title |section |caption |asdf|qwer|jkl|foo bar|blah|xxx"
).split("|")
_PARTS = re.compile(r"(?<=[.!?。！？।؟])\s+|(?<=[。！？])|\n+")
_RESIDUE = re.compile("|".join(f"(?:{p})" for p in _NOTICE + _FILLER), re.IGNORECASE)
_SENTENCE_END = re.compile(r"[.!?。！？।؟…]['\"”’»)\]]*\s*$")


@lru_cache(maxsize=1)
def _cues():
    import ahocorasick

    found = ahocorasick.Automaton()
    for w in _CUES:
        found.add_word(w, w)
    found.make_automaton()
    return found


def _is_residue(part: str, cues) -> bool:
    low = part.lower()
    if next(cues.iter(low), None) is not None and _RESIDUE.search(part):
        return True
    words = low.split()
    return len(words) > 3 and len(set(words)) == 1


def _repeats(words: list[str]) -> bool:
    """Whether a word stands three times in a row, as in every part that is one word repeated."""
    return any(a == b == c for a, b, c in zip(words, words[1:], words[2:]))


def _pure(line: str, cues) -> bool:
    """Every sentence of the line is residue; an exclamation of up to three words ("Oops! ...") belongs to the next."""
    bad = False
    for part in _PARTS.split(line):
        if not part or part.isspace():
            continue
        if _is_residue(part, cues):
            bad = True
        elif part[-1] not in "!！" or len(part.split()) > 3:
            return False
    return bad


def trusted_lines(text: str) -> tuple[bool, set[int]]:
    """(the text consists of notices, error messages or filler only, its lines that do).

    Lines are read only where so little content stands beside those with a cue that the
    document can be residue at all.
    """
    cues, low = _cues(), text.lower()
    if len(text) > 80 and next(cues.iter(low), None) is None and not _repeats(low.split()):
        return False, set()
    lines = text.split("\n")
    may, good = 0, 0
    for line in lines:
        small = line.lower()
        if next(cues.iter(small), None) is not None or _repeats(small.split()) or len(set(small.split())) == 1:
            may += len(line)
        elif is_content(line):
            good += len(line)
    if good > 0.3 * may:
        return False, set()
    pure = {i for i, line in enumerate(lines) if _pure(line, cues)}
    return bool(pure) and all(i in pure or not line.strip() for i, line in enumerate(lines)), pure


def trusted(text: str) -> bool:
    """The text consists of notices, error messages or filler and of nothing else."""
    return trusted_lines(text)[0]


def is_content(line: str) -> bool:
    """A line with a sentence in it, not a title or a menu."""
    return len(line) >= 12 and _SENTENCE_END.search(line) is not None


def _text(c: str = "text") -> Column:
    return F.col(c).cast("string")


def slot_names(documents: DataFrame) -> DataFrame:
    """(name): slot names seen inside unmistakable placeholder marks."""
    found = F.flatten(F.array(*[F.expr(f"regexp_extract_all(text, {_sql(p)}, 1)") for p in _SURE]))
    has = documents.where(_text().rlike("|".join(f"(?:{p})" for p in _SURE))).select(_text().alias("text"))
    return has.select(F.explode(found).alias("name")).select(F.lower(F.trim("name")).alias("name")).where("name <> ''").distinct()


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", "[\\u0027]") + "'"


def marked(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, text, sure, unsure, dummy): documents with marks of a template or dummy Latin, in one pass."""
    sure, unsure = ("|".join(f"(?:{p})" for p in bank) for bank in (_SURE, _UNSURE))
    t = F.col("text")
    slots = t.contains("{") | t.contains("[")
    rows = documents.select(F.col(key).alias("doc_id"), _text().alias("text")).select(
        "doc_id", "text", ((slots | t.rlike("<|@@|%|__")) & t.rlike(sure)).alias("sure"), (slots & t.rlike(unsure)).alias("unsure"), t.rlike(_DUMMY_RUN).alias("dummy")
    )
    return rows.where("sure OR unsure OR dummy")


def placeholder_docs(hits: DataFrame) -> DataFrame:
    """(doc_id): documents of ``marked`` with an unfilled slot."""
    found = F.flatten(F.array(*[F.expr(f"regexp_extract_all(text, {_sql(p)}, 1)") for p in _UNSURE]))
    unsure = (
        hits.where("unsure")
        .select("doc_id", F.explode(F.array_distinct(found)).alias("name"))
        .select("doc_id", F.lower("name").alias("name"))
        .join(slot_names(hits.where("sure")), "name", "left_semi")
        .select("doc_id")
    )
    return hits.where("sure").select("doc_id").unionByName(unsure).distinct()


# ------------------------------------------------------------------ near-duplicates


_WORD = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]|(?:[^\W_]|[\u0300-\u036f\u0610-\u065f\u0900-\u0963])+")
_DIGITS = re.compile(r"\d+")


def words(text: str) -> list[str]:
    """Lower-case words; a letter of a script without spaces is a word; digits are one sign."""
    return _WORD.findall(_DIGITS.sub("0", text.lower()))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


class _WordHashes(dict):
    """64-bit hash of each word, kept for the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_WORD_HASH = _WordHashes()


def _hashes_of(found: list[str]) -> np.ndarray:
    return np.array([_WORD_HASH[w] for w in found], dtype=np.uint64)


def _runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words."""
    n = len(h) - k + 1
    out = h[:n].copy()
    for i in range(1, k):
        out = out * _STEP + h[i : i + n]
    out ^= out >> np.uint64(29)
    out *= _MIX
    return out ^ (out >> np.uint64(32))


def _shingles(h: np.ndarray) -> np.ndarray:
    return np.unique(_runs(h, min(WORDS_PER_SHINGLE, len(h)))) if len(h) else np.zeros(1, dtype=np.uint64)


def shingles(text: str) -> list[int]:
    """Sorted distinct 64-bit hashes of the runs of five words (of all words where they are fewer)."""
    return _shingles(_hashes_of(words(text))).tolist()


def prefix(hashes: list[int]) -> np.ndarray:
    """The least hashes of a set, as many as any set of the needed similarity must share one of."""
    n = len(hashes)
    return np.array(hashes[: n - math.ceil(MIN_SIMILARITY * n - 1e-9) + 1], dtype=np.uint64).view(np.int64)


def simhash(hashes: list[int]) -> int:
    """64-bit SimHash, as a signed number."""
    bits = np.unpackbits(np.asarray(hashes, dtype=np.uint64).view(np.uint8).reshape(-1, 8), axis=1)
    return int(np.packbits(bits.sum(axis=0) * 2 > len(bits)).view(np.int64)[0])


_VIEW = T.StructType(
    [
        T.StructField("view", T.IntegerType()), T.StructField("class", T.StringType()), T.StructField("hash", T.LongType()), T.StructField("n_shingles", T.IntegerType()),
        T.StructField("n_chars", T.IntegerType()), T.StructField("content", T.BooleanType()), T.StructField("trusted", T.IntegerType()), T.StructField("prefix", T.ArrayType(T.LongType())),
    ]
)


def views_of(text: str) -> list[tuple]:
    """The views of a text that hold words: 0 is the whole text, 1.. its lines (one line is the whole)."""
    lines = text.split("\n")
    found = [words(x) for x in lines]
    h = _hashes_of([w for f in found for w in f])
    whole, pure = trusted_lines(text)
    out = []

    def add(view: int, part: np.ndarray, line: str) -> None:
        seed = WHOLE if whole else LINE if view - 1 in pure else 0
        s = _shingles(part)
        out.append((view, xxhash.xxh3_128_hexdigest(part.tobytes()), simhash(s), len(s), len(line), is_content(line), seed, prefix(s)))

    if len(h):
        add(0, h, text)
    if sum(map(bool, found)) > 1:
        at = 0
        for i, (line, f) in enumerate(zip(lines, found)):
            if f:
                add(i + 1, h[at : at + len(f)], line)
            at += len(f)
    return out


@F.pandas_udf(T.ArrayType(_VIEW))
def _views(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    names = _VIEW.names
    for texts in batches:
        yield pd.Series([[dict(zip(names, v)) for v in views_of(t)] for t in texts])


@F.pandas_udf(T.StringType())
def view_text(texts: pd.Series, views: pd.Series) -> pd.Series:
    return pd.Series([t if v == 0 else t.split("\n")[v - 1] for t, v in zip(texts, views)], dtype=object)


@F.pandas_udf(T.ArrayType(T.LongType()))
def shingle_set(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: np.array(shingles(t), dtype=np.uint64).view(np.int64))


def views(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, total, view, class, hash, n_shingles, n_chars, content, trusted, prefix) of every view with words.

    ``total`` is the length of the document. Null and blank texts have no row.
    """
    texts = documents.where(_text().rlike(r"[^\s\p{Z}]")).select(F.col(key).alias("doc_id"), _text().alias("text"))
    return texts.select("doc_id", F.length("text").alias("total"), F.explode(_views("text")).alias("v")).select("doc_id", "total", "v.*")


def classes(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """The whole texts among ``views``."""
    return views(documents, key).where("view = 0")


def _bucket() -> Column:
    return F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1 / MIN_SIMILARITY))).cast("int")


def _near_buckets() -> Column:
    return F.explode(F.array(_bucket() - 1, _bucket(), _bucket() + 1))


def _tables(reps: DataFrame, probe: bool) -> DataFrame:
    """One row per band; with ``probe`` also for the neighbouring length buckets."""
    step = 64 // BANDS
    bands = ", ".join(
        f"named_struct('band', {b}, 'bits', CAST((shiftrightunsigned(hash, {(b * step) % 64}) | shiftleft(hash, {(64 - b * step) % 64})) & {(1 << BAND_BITS) - 1} AS int))" for b in range(BANDS)
    )
    near = _near_buckets() if probe else _bucket()
    return reps.select("class", "hash", "n_shingles", near.alias("bucket"), F.expr(f"array({bands})").alias("b")).selectExpr("class", "hash", "n_shingles", "bucket", "inline(b)")


def propagate(reps: DataFrame, texts: DataFrame | Callable[[DataFrame], DataFrame], labelled: DataFrame) -> DataFrame:
    """(class): ``labelled`` classes and every class connected with them by near-duplicate links.

    ``reps`` has class, hash, n_shingles and prefix, one row per class,
    ``texts`` has (class, text), or gives them for the classes it is asked for. Pairs that no SimHash table brings together are found by
    their least shingles within the length buckets: two sets of the needed similarity share
    one of these, so no link is lost. Lengths outside the frontier's range are not read.
    """
    found = materialise(labelled.select("class").distinct(), "residue-round")
    frontier = found
    while True:  # each round adds a class, so it ends
        front = materialise(reps.join(frontier, "class", "left_semi"), "residue-front")  # its size is known, so a small one is not met by a shuffle of all tables
        lengths = front.agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi")).first()
        if lengths["lo"] is None:
            break
        near_len = reps.where(F.col("n_shingles").between(math.floor(MIN_SIMILARITY * lengths["lo"]), math.ceil(lengths["hi"] / MIN_SIMILARITY)))
        probe = _tables(front, probe=True).select(F.col("class").alias("a"), F.col("hash").alias("ha"), F.col("n_shingles").alias("na"), "bucket", "band", "bits")
        pairs = (
            _tables(near_len, probe=False).join(probe, ["band", "bits", "bucket"])
            .where("a <> class AND bit_count(ha ^ hash) <= " + str(MAX_HAMMING))
            .select("a", "class", "na", "n_shingles")
        )
        least = near_len.select("class", "n_shingles", _bucket().alias("bucket"), F.explode("prefix").alias("shingle"))
        asked = front.select(F.col("class").alias("a"), F.col("n_shingles").alias("na"), "prefix", _near_buckets().alias("bucket"))
        asked = asked.select("a", "na", "bucket", F.explode("prefix").alias("shingle"))
        pairs = pairs.unionByName(least.join(asked, ["bucket", "shingle"]).where("a <> class").select("a", "class", "na", "n_shingles"))
        pairs = (
            pairs.where(f"least(na, n_shingles) >= {MIN_SIMILARITY} * greatest(na, n_shingles)").select("a", "class").distinct().join(found, "class", "left_anti")
        )
        pairs = materialise(pairs, "residue-pairs")
        if pairs.isEmpty():
            break
        wanted = pairs.select("class").unionByName(pairs.select(F.col("a").alias("class"))).distinct()
        sets = materialise((texts(wanted) if callable(texts) else texts.join(wanted, "class", "left_semi")).select("class", shingle_set("text").alias("s")), "residue-sets")
        both = pairs.join(sets, "class").join(sets.select(F.col("class").alias("a"), F.col("s").alias("sa")), "a")
        common = F.size(F.array_intersect("s", "sa"))
        alike = common >= MIN_SIMILARITY * (F.size("s") + F.size("sa") - common)
        new = materialise(both.where(alike).select("class").distinct(), "residue-round")
        if new.isEmpty():
            break
        found = materialise(found.unionByName(new), "residue-round")
        frontier = new
    return found


def labelled_docs(members: DataFrame, linked: DataFrame) -> DataFrame:
    """(doc_id, route): documents whose whole text is labelled, or whose labelled lines leave only a title or menu.

    At most three tenths as much content (lines with a sentence) may stand beside the
    labelled lines, and titles and menus of five times their length and 120 characters.
    route: ``trusted`` (nothing but residue), ``linked`` (found through its classes) or
    ``line`` (a message that no document consists of).
    """
    labels = members.select("class", "trusted").join(linked, "class", "left_semi").groupBy("class").agg(F.max("trusted").alias("label"))
    flagged = members.select("doc_id", "total", "view", "class", "n_chars", "content", "trusted").join(labels, "class", "left")
    line, hit = F.col("view") > 0, F.col("label").isNotNull()
    sums = flagged.groupBy("doc_id").agg(
        F.max((F.col("view") == 0) & hit).alias("whole"),
        F.max("total").alias("total"),
        F.sum(F.when(line & hit, F.col("n_chars")).otherwise(0)).alias("bad"),
        F.sum(F.when(line & ~hit & F.col("content"), F.col("n_chars")).otherwise(0)).alias("good"),
        F.max("trusted").alias("own"),
        F.min(F.when(hit, F.col("label"))).alias("label"),
    )
    route = F.when(F.col("own") == WHOLE, "trusted").when((F.col("own") == LINE) & (F.col("label") == LINE), "line").otherwise("linked")
    return sums.where("whole OR (bad > 0 AND good <= 0.3 * bad AND total <= 6 * bad + 120)").select("doc_id", route.alias("route"))


def residue_docs(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, reason): placeholder, dummy (runs of dummy words), or the route of ``labelled_docs``."""
    members = materialise(views(documents, key), "residue-views")  # hashed once, scanned every round
    marks = materialise(marked(documents, key), "residue-marks")
    reps = materialise(members.select("class", "hash", "n_shingles", "prefix").distinct(), "residue-classes")
    one = F.min(F.struct("doc_id", "view")).alias("at")

    def texts_of(classes: DataFrame) -> DataFrame:
        at = members.select("class", "doc_id", "view").join(classes, "class", "left_semi").groupBy("class").agg(one).select("class", "at.doc_id", "at.view")
        return documents.select(F.col(key).alias("doc_id"), _text().alias("text")).join(at, "doc_id").select("class", view_text("text", "view").alias("text"))

    linked = propagate(reps, texts_of, members.where("trusted > 0"))
    out = labelled_docs(members, linked).withColumnRenamed("route", "reason")
    for df, reason in ((marks.where("dummy"), "dummy"), (placeholder_docs(marks), "placeholder")):
        out = out.unionByName(df.select("doc_id", F.lit(reason).alias("reason")))
    return out.groupBy("doc_id").agg(F.max("reason").alias("reason"))


def without_residue(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """The corpus without residue documents, all columns kept."""
    bad = residue_docs(documents, key).select(F.col("doc_id").alias("_residue_id"))
    return documents.join(bad, F.col(key) == F.col("_residue_id"), "left_anti")
