"""Template residue, filler, error pages and script notices in place of content.

Texts are cut into messages (lines, and sentences within them). Numbers, dates,
addresses, paths and quoted values are masked, and all masked messages, whatever
they say, are grouped by their hash across documents and sources, by partial
counts. What recurs widely is classified once a group, by what its words are
about: an object of the web that fails, scripts that have to be allowed, content
that is still to come. Only shapes that no real text has, unfilled slots and
pseudo-Latin, are residue in a single document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.runtime import settle

#: A message recurs widely if so many documents of so many sources hold it.
MIN_DOCS, MIN_SOURCES = 3, 2
#: Texts handed from one Arrow batch to Python at once.
STEP = 256

_NAME = r"[^\W\d][\w.\-]*"
_TAGS = "a|abbr|article|aside|b|blockquote|body|br|button|code|dd|div|dl|dt|em|footer|form|h[1-6#]|head|header|hr|html|i|iframe|img|input|kbd|li|link|main|meta|nav|noscript|ol|option|p|pre|s|script|section|select|small|span|strong|style|sub|sup|svg|table|tbody|td|tfoot|th|thead|title|tr|u|ul|video"

# The forms of an unfilled slot.
SLOTS = [
    rf"\{{\{{\s*\$?{_NAME}(?: {_NAME})*\s*\}}\}}", rf"\[\[\s*{_NAME}(?: {_NAME})*\s*\]\]", rf"<<\s*{_NAME}(?: {_NAME})*\s*>>", rf"«{_NAME}»", r"\$\{[^{}\n]{1,60}\}", rf"%{_NAME}%",
    r"<\?[^?<>\n]{1,60}\?>", r"<%[^%<>\n]{1,60}%>", r"%\([\w.\-]{1,40}\)[sd]", rf"(?<![\w])__[^\W\d_][^\W_.\-]*(?:[_.\-][^\W_.\-]+)*__", rf"@@{_NAME}@@", rf"(?<![\w#])#{_NAME}#",
    rf"(?<!\[)\[(?!(?:sic|NAME|note|ed|i|ii|iii|iv|v|vi|a|b|c|p|s|f|ff)\]){_NAME}\](?![\](])", r"\[[^\]\n]{1,40} (?:here|hier einsetzen|hier eintragen|aquí|ici)\](?!\()", r"\[(?:insert|enter|your|please|add|此处|请|待|hier|bitte|inserta|introduzca|insérer|indiquer|ici|aquí)[^\]\n]{0,60}\](?!\()",
    rf"(?<![{{$\"])\{{\s*{_NAME}\s*\}}(?!\}})", rf"(?<!<)<(?!(?i:/|{_TAGS})\s*/?>){_NAME}>(?!>)", r"[（(]\s*(?:请填写|待填写|此处填|insert |please fill|bitte ausfüllen|bitte eintragen|por rellenar|rellenar|à compléter|à remplir)[^）)\n]{0,60}[）)]",
]
# Words of sentences that speak about slots instead of leaving one.
SPEAKS_OF = r"(?i)placeholder|\btemplate|merge field|\bthe (?:field|tag|variable)\b|\bthe mail run\b|platzhalter|vorlage|\bfeld\b|\bmarke\b|seriendruck|marcador|plantilla|\bcampo\b|\betiqueta|combinación|\bchamp\b|\bbalise|\brepère|modèle|publipostage|占位符|模板|字段|标记|标签|域"
# The vocabulary of pseudo-Latin filler.
LATIN = "lorem ipsum dolor dolore amet consectetur consectetuer adipiscing elit eiusmod tempor incididunt labore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim laborum vestibulum pellentesque viverra morbi felis auctor dictum tempus nunc vitae curabitur maecenas suspendisse tincidunt faucibus pretium gravida sodales lectus quam massa urna molestie vulputate ultrices aliquet ornare pulvinar".split()

# What the words of a message are about; stems in lower case, * for any ending, for en, de, fr, es, it, pt, nl and zh.
CONCEPTS = {
    "script": "javascript js script scripts scripting skript skripte skripten skript-blocker 脚本 javascripts",
    "run": "enabl* activ* actív* aktivier* allow allows turn turned switch* permit* habilit* autoris* autoriz* erlaub* zulass* schalten einschalt* abgeschalt* ausgeschalt* deaktiv* disabl* désactiv* desactiv* deshabilit* disattiv* need needs requir* requier* requer* benötig* erforderlich necesit* nécessit* besoin block* bloqu* blockier* richiest* attiv* ativ* inschakel* run runs executes ejecuta exécut* führt esegue 启用 开启 允许 需要 关闭 停用 拦截 阻止 执行 屏蔽",
    "reload": "reload* refresh* recarg* recharg* neu ricaric* 刷新",
    "load": "loading cargando chargement geladen caricamento carregando laden 加载",
    "web": "page pages site website server servers gateway backend proxy session connection link url host requests address document item entry application seite server sitzung verbindung link adresse dokument eintrag anfragen serveur connexion lien adresse requêtes passerelle élément página pagina sitio servidor sesión conexión enlace dirección documento peticiones solicitudes pasarela elemento sessione collegamento sessão ligação verbinding inhalt 页面 网页 服务器 会话 登录 连接 链接 文档 地址 请求 访问 网关 系统 网站 权限",
    "hard": "unavailable unreachable expired ended timeout timed lost overloaded busy withdrawn forbidden unauthorized denied maintenance failed failure moved abgelaufen überlastet unerreichbar zeitüberschreitung abgerissen unterbrochen zurückgezogen verweigert wartung* gewartet fehlt fehlgeschlagen introuvable indisponible expiré expirée saturé surchargé refusé interdit perdue interrompue retiré dépassé movido caducado expirado agotado perdido saturado ocupado sobrecargado retirado denegado mantenimiento scaduta scaduto manutenzione expirou manutenção verlopen onderhoud 找不到 失效 过期 超时 中断 断开 繁忙 撤回 拒绝 禁止 维护 不可用 丢 移走",
    "deny": "not no never cannot n't nicht keine kein nie pas plus n' aucun no ningún nunca non não niet 不 没有 未 无",
    "there": "found located exist exists existed available reachable respond responding open view permission gefunden gibt existiert verfügbar erreichbar abrufbar antwortet berechtigung trouvée trouvé existe disponible droit permis autorisation encontrada encontrado existe permiso trovata trovato gevonden 存在 找到 权限 响应",
    "much": "many viele trop demasiadas demasiados troppe muitas 过多 频繁",
    "fault": "wrong error fehler erreur errore erro fout exception 错误 异常",
    "sudden": "wrong unexpected internal unknown fatal uncaught occurred unerwarteter interner unbekannter aufgetreten inattendue interne inconnue survenue inesperado interno desconocido producido imprevisto inesperado 未知 内部 发生 出现",
    "draft": "sample dummy placeholder filler blindtext mustertext platzhaltertext platzhalter fülltext muestra relleno faux segnaposto exemplo 示例 占位 样本",
    "piece": "blindtext mustertext platzhaltertext fülltext text copy content section paragraph summary page texto contenido resumen párrafo texte contenu résumé paragraphe inhalt abschnitt absatz zusammenfassung testo contenuto conteúdo tekst inhoud 文字 正文 内容 摘要 段落",
    "later": "pending follow follows soon goes here replace folgt folgen hier später ersetzen eingefügt pendiente completar aquí sustituir reemplazar venir compléter ici remplacer qui sostituire substituir volgt 待补充 待定 稍后 此处 替换 填写 即将",
    "again": "again later back while wait minutes später erneut noch tarde vuelva réessayez revenez tard intente riprova tentar 稍后 再试 恢复",
}
# Whole messages that say that something is still to be written.
OPEN_MARKS = frozenset("tbd tba todo fixme n.n".split())
# Words of sentences that tell a reader about such messages within real content.
EXPLAINS = r"(?i)\b(?:only|solo|sólo|nur|exige|seulement|means|called|says|reads|if you see|customers?|example|for instance|bedeutet|heißt|meldung|kund(?:e|en|innen)|zum beispiel|signifie|message|clients?|par exemple|significa|mensaje|clientes?|por ejemplo)\b|表示|意思|提示语|客户|例如"

_EDGE = "#>*•|_=~- \t\r\u00a0"
_HAN = re.compile(r"[㐀-鿿]")
# Entries of a site's navigation, which may stand before a message in the same line.
_NAV = re.compile(r"(?:home|search|login|products|claims|imprint|start|anmelden|produkte|suche|impressum|leistungen|inicio|buscar|entrar|productos|siniestros|aviso|accueil|recherche|connexion|produits|sinistres|mentions|首页|登录|搜索|产品|理赔|版权)\b", re.I)
_CAPITAL = re.compile(r"(?<=\s)[A-ZÀ-Þ{\d㐀-鿿<]")
_IF = re.compile(r"\b(?:if|when|once|although|though|provided|in case|after|because|wenn|falls|sobald|sofern|obwohl|nachdem|si|lorsque|quand|dès que|bien que|pourvu|puisque|alors que|cuando|una vez|aunque|pese a|siempre que|después de|se|als)\b|如果|若|虽然|即使|一旦|只要")
# a page of someone named is spoken about, a notice speaks of its own page
_PAGE_OF = re.compile(r"\b(?:page|site|portal|seite|página)s?\s+(?:of|von|der|des|de|d['’<])|的\w{0,4}(?:页面|网站|门户)")
_STOP = re.compile(r"[.!?](?=\s)|[。！？]")
_TAG = re.compile(rf"</?(?:{_TAGS.replace('[1-6#]', '[1-6]')})(?:\s[^<>]*)?/?>", re.I)
_ADDRESS = re.compile(r"\b(?:https?://|www\.)\S+|\b[\w.+-]+@[\w-]+\.[\w.]+|\b\d{1,3}(?:\.\d{1,3}){3}\b", re.I)
_NUMBER = re.compile(r"[0-9０-９]\d*([-/.年]\d{1,2}[-/.月]\d{1,4}日?(?!\d))?(?:[.,]\d+)*")
# what begins with a rare sign is looked for first: three dots of an address in numbers, the second dot of a dotted name
_MAY_BE_IP, _MAY_BE_DOTTED = re.compile(r"\.\d{1,3}\.\d"), re.compile(r"\.\w+\.[\w$<]")
_BLANKS = {i: 32 for i in range(128) if not chr(i).isalpha()}
#: A status code of the web, at the start of a line or after one word.
_CODE = re.compile(r"(?m)^([\W_]*(?:[^\W\d]+ ?(?:#|http)? ?)?[ (（:]?)[45]\d\d(?=[)）]?(?:\s*[–:-]|\s+[^\W\d]|\s*[)）.。]?\s*$))")
_PATH = re.compile(r"/(?<![\w/].)[\w.\-]+(?:/[\w.\-]+)+")
_DOTTED = re.compile(r"\b(?:[A-Za-z_]\w+\.){2,}[\w$<>]+")
_JSON_VALUE = re.compile(r":\s*\"[^\"]*\"?|(?<=: )'[^'\n]*'")
_MAY_BE_SLOT = re.compile(r"[\[{<«%$@#_（(](?:(?<=[%#«])[^\W\d]|(?<=%)\(|(?<=[\[{<])[\[{<?%]?\s*\$?[^\W\d]|(?<=<)[?%]|(?<=\$)\{|(?<=@)@|(?<=_)_|(?<=[（(])\s*(?:请填|待填|此处填|insert|please|bitte|por|rellenar|à))")
_SPLIT = re.compile(r"[\W\d_]+")
_TICKED = re.compile(r"'[^'\n]*'")
_QUOTED = re.compile(r"`[^`\n]*`|[\"“”„][^\"“”\n]{1,60}[\"“”]")
_WORDS = re.compile(r"[^\W\d_]+")
_LATIN_WORDS = re.compile(r"[^\W\d_㐀-鿿]+")
_TRACE = re.compile(r"traceback \(most recent call last\)|file \"?<path>\"?, line #|at <path>\(|(?:\w*(?:error|exception)|<path>(?:error|exception)?)(?:: .{0,80})?\Z|\{\s*\"?error\"?\s*:")
_LATIN = frozenset(LATIN)


@lru_cache(maxsize=1)
def _rules() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    return re.compile("|".join(SLOTS)), re.compile(SPEAKS_OF), re.compile(EXPLAINS)


@lru_cache(maxsize=1)
def _lexicon() -> tuple[dict[str, frozenset[str]], list[tuple[str, frozenset[str]]], list[tuple[str, frozenset[str]]]]:
    """Words, beginnings of words and Chinese strings with the concepts that each stands for."""
    words: dict[str, set[str]] = {}
    heads: dict[str, set[str]] = {}
    signs: dict[str, set[str]] = {}
    for concept, spec in CONCEPTS.items():
        for w in spec.split():
            into = signs if _HAN.match(w) else heads if w.endswith("*") else words
            into.setdefault(w.rstrip("*"), set()).add(concept)
    froze = lambda d: [(w, frozenset(c)) for w, c in d.items()]
    return dict(froze(words)), froze(heads), froze(signs)


@lru_cache(maxsize=1 << 16)
def _word_concepts(word: str) -> frozenset[str]:
    words, heads, _ = _lexicon()
    out = set(words.get(word, ()))
    for h, c in heads:
        if word.startswith(h):
            out |= c
    return frozenset(out)


def concepts(message: str) -> tuple[frozenset[str], int]:
    """What the words of a masked message are about, and how many words it has (two Chinese signs count as one)."""
    found: set[str] = set()
    han = len(_HAN.findall(message)) if not message.isascii() else 0
    words = _LATIN_WORDS.findall(message)
    n = len(words) + (han + 1) // 2
    for w in words:
        found |= _word_concepts(w)
    if han:
        for s, c in _lexicon()[2]:
            if s in message:
                found |= c
    return frozenset(found), n


def kind_of_group(message: str) -> str | None:
    """``error``, ``script`` or ``filler`` if a masked message that recurs widely can only stand in place of content."""
    if _TRACE.match(message):
        return "error"
    has, n = concepts(message)
    if message in OPEN_MARKS:
        return "filler"
    coded = "<code>" in message
    if n > 24 or not (has or coded) or _rules()[2].search(message) or "load" not in has and _IF.search(message) or _PAGE_OF.search(message):
        return None
    # a title of the error page: its code with nothing or few words
    if coded and (n <= 1 or n <= 6 and has & {"web", "hard", "fault", "deny"} or n <= 2 and "fault" in has):
        return "error"
    if "script" in has and has & {"run", "reload", "load", "hard"} or {"run", "reload"} <= has and n <= 10 or "load" in has and ("…" in message or "..." in message):
        return "script"
    if "web" in has and ("hard" in has or {"deny", "there"} <= has or {"deny", "much"} <= has or "much" in has and n <= 12):
        return "error" if n <= 16 else None
    if n <= 8 and ("fault" in has and has & {"sudden", "hard"} or {"hard", "sudden"} <= has) or n <= 12 and {"hard", "again"} <= has or n <= 3 and ({"deny", "there"} <= has or "hard" in has):
        return "error"
    if n <= 9 and ({"draft", "piece"} <= has or {"piece", "later"} <= has or {"draft", "later"} <= has or "draft" in has and "deny" in has):
        return "filler"
    return None


@lru_cache(maxsize=1)
def _stems():
    """Automatons of all that a group has to hold for any rule, in Latin letters (between blanks) and Chinese: what lacks it needn't be shown to the rules."""
    import ahocorasick

    latin, han = ahocorasick.Automaton(), ahocorasick.Automaton()
    for concept in ("script", "reload", "load", "hard", "there", "much", "fault", "draft", "later"):
        for w in CONCEPTS[concept].split():
            han.add_word(w.rstrip("*"), 1)
            latin.add_word(f" {w}".rstrip("*") if w.endswith("*") else f" {w} ", 1)
    for w in ("code", "path", "traceback", *OPEN_MARKS):
        han.add_word(w, 1)
        latin.add_word(f" {w} ", 1)
    for a in (latin, han):
        a.add_word("exception", 1)
        a.add_word("error", 1)
        a.make_automaton()
    return latin.iter, han.iter


def _may(m: str) -> bool:
    latin, han = _stems()
    if len(m) < 2:
        return False
    if m.isascii():
        return next(latin(f" {m.translate(_BLANKS)} "), None) is not None
    if _HAN.search(m):
        return next(han(m), None) is not None
    return next(latin(f" {_SPLIT.sub(' ', m)} "), None) is not None


def masked(text: str) -> str:
    """``text`` without markup, with status codes, addresses, dates, paths and numbers masked."""
    if "<" in text:
        text = _TAG.sub("\n", text)
    if "@" in text or "://" in text or "www." in text or _MAY_BE_IP.search(text):
        text = _ADDRESS.sub("<addr>", text)
    if "/" in text:
        text = _PATH.sub("<path>", text)
    if _MAY_BE_DOTTED.search(text):
        text = _DOTTED.sub("<path>", text)
    if '{"' in text or "{'" in text:
        text = "\n".join(_JSON_VALUE.sub(": <q>", x) if x.lstrip()[:1] == "{" else x for x in text.split("\n"))
    return _NUMBER.sub(lambda m: "<date>" if m[1] else "#", _CODE.sub(r"\1<code>", text))


def messages(text: str) -> Iterator[str]:
    """The lines of a text, and the sentences of each."""
    for line in text.split("\n"):
        at = 0
        if line.lstrip()[:1] != "{":
            for m in _STOP.finditer(line):
                yield line[at : m.end()]
                at = m.end()
        if at < len(line):
            yield line[at:]


def form(message: str) -> str:
    """A masked message in lower case without bullets, closing signs and quoted names."""
    m = message.partition("©")[0] or message
    m = " ".join(m.lower().split()).lstrip(_EDGE).rstrip(" .。!！?？|*_")
    return _TICKED.sub("<q>", m) if "'" in m and ":" in m else m


def slots(text: str) -> list[str]:
    """The messages of a text with an unfilled slot, with numbers masked."""
    rule, speaks, _ = _rules()
    if "<" in text:
        text = _TAG.sub("\n", text)
    if _MAY_BE_SLOT.search(text) is None:
        return []
    return [form(_NUMBER.sub("#", m)) for m in messages(text) if _MAY_BE_SLOT.search(m) and rule.search(m) and not speaks.search(m) and rule.search(_QUOTED.sub(" ", m))]


def _filler(m: str) -> bool:
    words = _WORDS.findall(m)
    n = sum(w in _LATIN for w in words)
    return n >= 2 and n * 4 >= len(words)


def _look(text: str) -> tuple[dict[str, bool], list[tuple[str, str]]]:
    """The forms of all messages of a text, whether a rule could hold for each, and the (kind, form) of those that are residue by their shape."""
    out: dict[str, bool] = {}
    sure = [("slot", m) for m in slots(text)]
    latin = len(_LATIN.intersection(text.lower().split())) > 1
    for message in messages(masked(text)):
        m = form(message)
        if not m:
            continue
        out[m] = _may(m)
        if latin and _filler(m):
            sure.append(("filler", m))
        elif out[m] and _STOP.search(message) is None and m.count(" ") < 40:
            # a heading, a line of navigation or a title may run into the message that follows it
            bare = message.lstrip(_EDGE)
            lead = message.startswith("#") or _NAV.match(bare) is not None
            for at in _CAPITAL.finditer(bare):
                if lead or kind_of_group(form(bare[: at.start()])):
                    if (rest := form(bare[at.start() :])) and _may(rest):
                        out[rest] = True
    return out, sure


def _messages(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, h, form, kind: one row for each message of each document; form only where a rule could hold or kind is certain."""
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.where(F.col(id_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), F.col(text_col).alias("text"))

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for lo in range(0, whole.num_rows, STEP):
                batch = whole.slice(lo, STEP)
                at, hashes, forms, kinds = [], [], [], []
                for i, text in enumerate(batch.column(2).to_pylist()):
                    seen, sure = _look(text)
                    for m, may in seen.items():
                        at.append(i)
                        hashes.append(xxhash.xxh64_intdigest(m) - (1 << 63))
                        forms.append(m if may else None)
                        kinds.append(None)
                    for kind, m in sure:
                        at.append(i)
                        hashes.append(xxhash.xxh64_intdigest(m) - (1 << 63))
                        forms.append(m)
                        kinds.append(kind)
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(hashes, pa.int64()), pa.array(forms, pa.string()), pa.array(kinds, pa.string())], ["doc_id", "source", "h", "form", "kind"])

    return src.mapInArrow(look, f"doc_id {id_type}, source string, h bigint, form string, kind string")


def _counts(m: DataFrame) -> DataFrame:
    """h, n_docs, n_sources, form of each group; counted from partial counts, so one message in a third of all documents is no hot group."""
    per = m.where("kind is null").select("h", "source", "doc_id").distinct().groupBy("h", "source").agg(F.count("*").alias("n"))
    return per.groupBy("h").agg(F.sum("n").alias("n_docs"), F.count("*").alias("n_sources"))


def message_groups(docs: DataFrame, min_docs: int = MIN_DOCS, min_sources: int = MIN_SOURCES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """h, n_docs, n_sources: the groups of equal masked messages that at least ``min_docs`` documents of ``min_sources`` sources hold (null is a source of its own)."""
    return _counts(_messages(docs, id_col, text_col, source_col)).where((F.col("n_docs") >= min_docs) & (F.col("n_sources") >= min_sources))


def residue_messages(docs: DataFrame, min_docs: int = MIN_DOCS, min_sources: int = MIN_SOURCES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, kind, message, decided, n_docs, n_sources: each residue message of each document, masked, once.

    kind is ``slot``, ``filler``, ``error`` or ``script``; decided is ``shape``
    for slots and pseudo-Latin, which hold in a single document, and
    ``recurrence`` for messages of groups that at least ``min_docs`` documents of
    ``min_sources`` sources hold (null is a source of its own); only for these
    the counts are given. Null and empty texts and rows without an id give no
    row; repeated documents count once.
    """
    m = settle(_messages(docs, id_col, text_col, source_col), "messages")
    wide = _counts(m).where((F.col("n_docs") >= min_docs) & (F.col("n_sources") >= min_sources))
    forms = m.where("kind is null and form is not null").groupBy("h").agg(F.max("form").alias("form"))

    def classify(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            kinds = pa.array([kind_of_group(f) for f in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, kinds], [*batch.schema.names, "kind"]).filter(kinds.is_valid())

    groups = wide.join(forms, "h").select("h", "form", "n_docs", "n_sources").mapInArrow(classify, "h bigint, form string, n_docs bigint, n_sources bigint, kind string")
    hits = m.where("kind is null and form is not null").select("h", "doc_id").join(groups, "h").select("doc_id", "kind", F.col("form").alias("message"), F.lit("recurrence").alias("decided"), "n_docs", "n_sources")
    none = F.lit(None).cast("long")
    shapes = m.where("kind is not null").select("doc_id", "kind", F.col("form").alias("message"), F.lit("shape").alias("decided"), none.alias("n_docs"), none.alias("n_sources"))
    return hits.unionByName(shapes).distinct()


def residue_documents(docs: DataFrame, **kw) -> DataFrame:
    """doc_id of every document with a residue message."""
    return residue_messages(docs, **kw).select("doc_id").distinct()


def without_residue(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` without the documents that hold residue; rows without an id stay."""
    return docs.join(residue_documents(docs, **kw), "doc_id", "left_anti")
