"""Template residue and error-page text.

One multi-pattern automaton runs once over each lower-cased text. Its patterns are of two kinds:

* marks open a placeholder; at each of them a grammar of placeholders is tried, and a field that
  stands where a value belongs decides at once. A field that the text talks about (in quotation marks
  or backticks of its own, in a fenced block, in a sentence about templates) is content;
* cues are wordings of error pages, failure messages, access checks, script notices and filler, in
  several languages.

A sentence is a notice if it holds a cue and is made up of the words that such messages use. A text that
as a whole is such a page is told by coverage: its notices, the menu words, codes and stack frames around
them make up most of its letters. Real content that quotes a notice has far more text than the
quotation. Filler without fixed wording is told by its form: forms with no field filled in, one unit
repeated over most of the text, words drawn from a small stock without any word that links them, and
keys struck at random. All rules hold for texts of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of a text's letters that must be covered for it to be a page without content.
COVERAGE = 0.7
#: Share of a sentence's letters in words of such pages: where it holds a cue, and where it does not.
NOTICE, FRAME = 0.6, 0.8

# Words that names of template fields are made of, in several languages.
FIELDS = """
author date time day month year city country place state region location address street zip postcode name names first last middle full nick
user username customer client company organization organisation employer department product item order invoice account reference number no
amount price total quantity phone telephone mobile fax email mail website site url link title subtitle chapter section heading subject topic
theme tone mood genre character hero heroine villain protagonist antagonist setting scene goal object summary text content body description
details keyword keywords quote reason position job role recipient sender signature id code event project task version image photo your the of here
nom prénom adresse ville auteur titre date lieu
vorname nachname anschrift stadt autor titel datum ort
nombre apellido dirección ciudad autor título fecha lugar
主角姓名 主角 反派 城市 日期 道具 概要 章节标题 章节 场景目标 场景 作者 姓名 标题 地点 时间 人物 角色 主题 正文 简介 名称 公司 地址 电话 邮箱 客户 产品 订单号 编号 金额 数量 描述 内容 关键词
""".split()

# Cues, wordings that error pages, access checks, script notices and filler are known by.
CUES = """
not found|cannot be found|can't be found|can’t be found|could not be|couldn't be|couldn’t be|can not be|cannot be|can't be|can’t be|could not connect|couldn't connect|can't connect|can’t reach|can't reach
does not exist|doesn't exist|doesn’t exist|no longer exists|no longer available|not available|isn't available|isn’t available|unavailable|is unreachable|no results|has been removed|was removed|been deleted|has been moved|been moved|moved permanently
failed to|has failed|generation failed|request failed|unable to|timed out|time out|time-out|timeout|went wrong|error occurred|error has occurred|an error|error|errors|oops|unexpected|exception|warning|fatal
access denied|access to this|denied|forbidden|unauthorized|not authorized|permission|do not have permission|not allowed|blocked|blocks|been suspended|suspended|been disabled|been banned|restricted
internal server|bad gateway|bad request|gateway|service unavailable|server at|too many|rate limit|rate exceeded|quota|exceeded|overloaded|slow down|aborted|stopped|was empty|is empty|empty response|empty completion|cut off|invalid token|invalid
signed out|logged out|session|expired|sign in to|sign in again|log in to|login required|please sign in|please log in|members only|subscribers only|subscribe to
javascript|enable cookies|cookies|cookie|scripts|scripting|script|js|noscript|ad blocker|adblock|browser is not supported|unsupported browser|outdated browser|your browser|update your browser
captcha|a robot|not a bot|you are human|you're human|you’re human|a human|verify|verifying|checking your|security check|security of your connection|unusual traffic|automated|letters you see|ddos|cloudflare|ray id|just a moment|one moment
maintenance|be back|coming soon|under construction|domain is for sale|domain name is for sale|is parked|parked domain|default page|it works|index of
traceback|stack trace|stack overflow|segmentation fault|core dumped|syntax error|parse error|null pointer|undefined index|undefined variable|connection refused|connection reset|out of memory|disk is full|no space left|lock wait|deadlock|database|open connections|errno|caused by
lorem ipsum|dolor sit amet|sample text|dummy text|placeholder text|filler text|example text|your text here|text here|content here|goes here|go here|insert text|insert your|add your|type your|enter your|write your|write a|add a|add the|add your own|describe the|describe your|replace this|replace it|replace with|edit this|edit me|title of your|your title|your closing|sample paragraph|dummy paragraph|example paragraph|first paragraph|body copy|copy to follow|to be written|to be added|to be completed|quick brown fox|blah blah|this is a test|just a test|testing|untitled|click to edit
不存在|无法显示|无法访问|无法加载|无法打开|无法连接|不能访问|加载失败|打开失败|失败|拒绝|禁止访问|没有权限|权限不足|出错|错误|繁忙|稍后再试|稍后重试|过于频繁|频繁|请登录|重新登录|登录已|已失效|失效|已过期|已下架|已删除|被删除|审核|为空|维护|验证码|安全验证|人机验证|滑块|启用|开启|请允许|不支持|禁用|不可用|脚本|浏览器|超时|暂无内容|敬请期待|建设中|找不到|未找到|被封|异常
测试文本|占位|示例|样例|这里是|此处为|在此输入|请输入|请填写|测试内容|测试数据|假文|填充文字
introuvable|n’existe|n'existe|n’est pas disponible|n'est pas disponible|indisponible|n’a pas pu|n'a pas pu|erreur|accès refusé|refusé|interdit|a expiré|expirée|bloqué|bloquée|bloque|veuillez activer|activer|désactivé|trop de requêtes|veuillez vous connecter|connexion requise|en maintenance|en construction|un robot|vérification|délai|impossible de|impossible d’|échec|texte d’exemple|texte d'exemple|votre texte ici|texte fictif|faux texte
nicht gefunden|nicht verfügbar|existiert nicht|konnte nicht|konnten nicht|kann nicht|fehler|zugriff verweigert|verweigert|verboten|abgelaufen|gesperrt|sperrt|blockiert|bitte aktivieren|aktivieren|aktiviere|deaktiviert|zu viele anfragen|bitte melden|anmelden|wartung|wartungsarbeiten|im aufbau|kein roboter|roboter|überprüf|zeitüberschreitung|fehlgeschlagen|skripte|blindtext|mustertext|beispieltext|platzhalter|ihr text hier|hier steht
no se encontró|no encontrada|no encontrado|no existe|no está disponible|no disponible|no se pudo|no se puede|error|acceso denegado|denegado|prohibido|caducó|caducado|expirado|bloqueado|bloqueada|bloquea|habilite|habilítelo|habilitar|active|activar|desactivado|demasiadas solicitudes|inicie sesión|iniciar sesión|mantenimiento|en construcción|un robot|verificación|verificando|fallo|falló|texto de ejemplo|texto de relleno|texto de prueba|su texto aquí
non trovata|non trovato|non disponibile|errore|accesso negato|abilita|disabilitato|manutenzione|não encontrada|não encontrado|não existe|não está disponível|indisponível|erro|acesso negado|habilite|ative|desativado|manutenção
не найдена|не найден|недоступна|недоступен|не существует|ошибка|доступ запрещен|доступ запрещён|включите|отключен|отключён|технические работы|見つかりません|見つかりませんでした|エラー|アクセスが拒否|有効にしてください|メンテナンス|利用できません|찾을 수 없습니다|오류|접근이 거부|활성화|점검 중
"""

# Words that such pages are made of beside the cues.
WORDS = """
the a an this that these those there your you yours we us our i it its it's it’s they them he she is are was were be been being am do does did done has have had will would can can't can’t cannot could couldn't may might must should not no none nor or and but if so as at to for of in on by from with without into onto over under about after before until while when where which who what why how than then again also only just still now soon later back here below above once more most all any some each every other another both few same own very too yet ago off up down out between through within via per
go try retry return reload refresh please sorry apologize apologise apologies regret thank thanks trouble inconvenience patience help terms privacy policy menu search skip main contents previous next front home homepage library rankings sign signed login log logged register password loading load loaded loads reader chapter article post page pages site website web url address link links broken server servers host request requested requests resource resources file files document documents entry item items record records scene story content contents image images video media object area region country network internet connection connected proxy client service services application app system program process worker job task step model output response reply result results data database table query upstream backend cache key token memory disk space limit limits number numbers
browser browsers javascript js cookie cookies script scripts scripting active noscript support supported supports setting settings change changes changed allow allows allowed unblock turn turned switch switched enable enabled enables disable disabled require required requires requirement need needs needed work works working run runs running properly correctly fully function functions functionality feature features experience view views viewing viewed read reading see display displayed displays show shown shows text continue use used using open opened opening access accessed
error errors code codes status http https reference incident case id ray ip event support contact desk team administrator admin webmaster owner staff report reported problem problems issue issues happened occurred occur occurs encountered appears looks seems like message messages detail details info information reason cause caused known unknown unexpected fault invalid missing empty full open lost found find available unavailable exist exists existed moved removed deleted renamed replaced expired changed temporarily temporary permanently currently moment minute minutes second seconds hour hours day days time times attempts attempt wait waiting waited planned scheduled maintenance down offline online busy overloaded slow quickly many much long visits traffic rate quota exceeded denied forbidden blocked banned suspended account accounts session robot robots bot human verify verified verifying verification check checking checked security secure complete completed completing challenge proceed letters type enter box image captcha visit visiting protect protected protection performance automated unusual activity detected requests computer device ensure make sure correct spelled spelling typed mistyped come came get got let know that's that’s all click button above below start started stop stopped stops failed fail fails failure failures unable aborted refused reset timed timeout line file module call calls last recent most exception trace stack null value values read write cut completion generation generated generate lock too plus version build apache nginx cloudflare port ubuntu debian unix red hat iis microsoft google server's cloud gateway bad internal method not-found good great kindly ask asked
hosting provider responding respond responded took take takes reached reach misconfiguration capacity downtime unreachable
страница страницы сайт сайта не найдена найден найдено ошибка ошибки сервер сервера доступ запрещен запрещён включите браузере браузер ваш вашем попробуйте позже пожалуйста для просмотра работы существует удалена перемещена или и в на с извините
title your write short introduction readers reader's space describe main conflict two three lines line add second first third scene below closing words come last paragraph paragraphs sample dummy example placeholder filler text texts goes go replace publishing published publish real copy follow follows edit block section heading headline subheading sentence sentences insert body content image caption own customize customise default untitled word words blah foo bar baz test tests testing template lorem ipsum layout design demonstrate demo purposes purpose only simply printing typesetting industry about
veuillez réessayer plus tard retour à l’accueil l'accueil accueil chapitre recharger rechargez rechargez-la la le les l un une des de du d ce cet cette ces votre vos vous nous notre est sont a été être avoir pas ne n en et ou au aux sur dans pour par avec puis que qui page pages site navigateur javascript scripts cookies ressource demandée demandé demande fichier contenu afficher affiche lire lecture continuer continuez activer activez autoriser autorisez-le débloquez-le bloque bloqué bloquée besoin fonctionne fonctionner correctement chargée chargé charger serveur erreur introuvable expiré expirée délai bout secondes minutes heures vérifiez vérifier l’adresse adresse désolé désolés excuses connexion connecter connecté compte accès refusé interdit trouvée trouvé existe plus disponible temporairement maintenance robot utiliser utilisation nécessaire nécessite requis cherchez recherchez recherchée recherché semble ici
bitte später erneut versuchen versuchen sie es zur zum startseite kapitel kennung neu laden lädt der die das den dem des ein eine einen einer ihr ihre ihren ihrem ihrer wir uns unsere diese dieser dieses diesem seite seiten website webseite browser javascript skripte skript cookies aktive aktiven aktivieren aktiviert zulassen freigeben sperrt gesperrt braucht benötigt erforderlich damit um zu und oder ist sind war wurde wurden wird werden nicht kein keine auf in im an am mit nach von für bei aus anfrage datei angeforderte angefragte inhalt inhalte text erscheint lesen weiterlesen weiterzulesen anzeigen angezeigt sehen funktioniert richtig fehler fehlercode server zugriff verweigert gefunden geladen konnte konnten kann können sekunden minuten stunden abgelaufen sitzung konto anmelden melden entschuldigung leider entschuldigen verfügbar existiert mehr vorübergehend wartung wartungsarbeiten roboter überprüfen prüfen haben hat sein suchen gesuchte gewünschte dass erneut zurück hier
inténtelo intente inténtalo más tarde de nuevo vuelva a intentarlo volver al inicio capítulo código recargar recargue recarga la el los las un una unos unas su sus tu tus nuestro nuestra lo se es son está están fue fueron ha han sido ser no en y o u con por para del que si como página páginas sitio web navegador javascript scripts script cookies ejecución active activar habilite habilítelo permita permítalo permitir necesita necesario requiere bloquea bloqueado bloqueada solicitud recurso solicitado solicitada archivo contenido texto ver leer leyendo seguir continuar mostrar cargar cargado cargada pudo puede servidor error encontró encontrada encontrado existe disponible temporalmente caducó segundos minutos horas acceso denegado prohibido sesión cuenta iniciar inicie robot verificar verificación compruebe dirección lamentamos sentimos disculpe disculpas molestias mantenimiento buscada busca funcionar funcione correctamente
"""
# The same for Chinese, where words are not set apart.
HAN_WORDS = """
您的 您 你 该 此 本 这 这个 那 我们 的 了 是 在 有 没有 和 与 或 以 后 再 并 及 等 请 需 需要 才能 可以 否则 如果 或者 可能 已经 已 被 正 正在 中 不 不能 不可 无法 无 未 为 对 于 到 从 将 会 也 都 就 让 由于 因为 所以 暂时 暂无 暂 目前 当前
页面 网页 网站 站点 网址 地址 链接 本站 本章 本章节 章节 章 第 节 正文 内容 文章 文件 资源 图片 数据 服务 服务器 系统 网络 连接 请求 访问 浏览 浏览器 处理 操作 应用 程序 功能 设置 脚本 账号 帐号 账户 密码 登录 注册 会话 用户 管理员 客服 联系 编号 代码 状态 信息 提示 原因 版本
启用 开启 打开 允许 更改 禁用 检测 检测到 支持 使用 正常 显示 查看 阅读 继续 继续阅读 刷新 加载 载入 返回 首页 书库 排行 目录 上一章 下一章 上一页 下一页 上页 下页 重试 尝试 稍后 稍候 秒 分钟 小时 次 年 月 日 完成 安全 验证 安全验证 拖动 滑块 拼图 输入 点击 按钮 重新 失效 失败 超时 错误 出错 不存在 存在 拒绝 禁止 权限 下架 删除 移除 移动 审核 为空 空 繁忙 频繁 过于 异常 维护 升级 建设 敬请 谅解 期待 见谅 抱歉 对不起 给您 带来 不便 感谢 耐心 等待 生成 模型 结果 响应 输出 不可用 可用 找不到 未找到 找到 加载失败 发生 出现 问题 未知 内部 网关 启动 更新 最新 换 其他 更换
测试 测试文本 文本 文字 占位 示例 样例 样本 这里 这里是 此处 填写 标题 段落 默认 假文 填充 简介 描述 请输入 请填写
"""

# The stock of common Lorem ipsum generators.
LOREM = """
lorem ipsum dolor sit amet consectetur consectetuer adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum
a ac accumsan aenean aliquam aliquet ante aptent arcu at auctor augue bibendum blandit class condimentum congue conubia convallis cras cubilia curabitur curae cursus dapibus diam dictum dictumst dignissim dis donec dui efficitur egestas eget eleifend elementum erat eros etiam euismod facilisi facilisis fames faucibus felis fermentum feugiat finibus fringilla fusce gravida habitant habitasse hac hendrerit himenaeos iaculis imperdiet inceptos integer interdum justo lacinia lacus laoreet lectus leo libero ligula litora lobortis luctus maecenas magnis malesuada massa mattis mauris maximus metus mi molestie mollis montes morbi mus nam nascetur natoque nec neque netus nibh nisl nostra nullam nunc odio orci ornare parturient pellentesque penatibus per pharetra phasellus placerat platea porta porttitor posuere potenti praesent pretium primis proin pulvinar purus quam quisque rhoncus ridiculus risus rutrum sagittis sapien scelerisque sem semper senectus sociosqu sodales sollicitudin suscipit suspendisse taciti tellus tempus tincidunt torquent tortor tristique turpis ullamcorper ultrices ultricies urna varius vehicula vel venenatis vestibulum vitae vivamus viverra volutpat vulputate
""".split()

# Words that link the others in prose, in languages with Latin letters.
LINKS = """
the a an of to and in is was were be for on with at by from as it he she they you we i his her that this not but or had have has
le la les un une des de du et à au aux en est il elle on que qui dans pour par sur ne pas se ce son sa ses avec plus
der die das den dem des ein eine einen und zu in ist war nicht mit auf für von im sich er sie es ich wir ihr als auch an bei nach
el los las una del y a en es que por con para su sus se no lo al como más era
il lo gli di e che per non si con del della o os as do da dos das em um uma não com é foi
de het een van en is op te dat niet met zijn och att det som på är av en ett inte med den og i er til på at det ikke
w i z na się nie do to jest że v a se na je že és az egy hogy nem ja on ei että ve bir bu da di yang dan itu ke dari untuk
""".split()

_WORD = re.compile(r"[^\W\d_]+(?:[’'][^\W\d_]+)*")
_HAN = re.compile(r"[㐀-鿿豈-﫿]")
_NAME = r"[A-Za-z_\u00c0-\u024f一-鿿][\w .\-一-鿿]*"
_FIELD = "(?:" + "|".join(re.escape(f) for f in sorted(set(FIELDS), key=len, reverse=True)) + ")"
_FIELDLIKE = rf"(?>{_FIELD}(?:[ _.\-]{{0,2}}{_FIELD})*)"
# The grammar of placeholders, by what opens them; bounded by the end of the line and by their own signs.
_GRAMMAR = {
    "{{": rf"\{{\{{[#/^&>!~-]?\s*{_NAME}(?:\|\s*[^{{}}\n]*)?\s*\}}\}}",
    "{%": r"\{%-?\s*\w[^%\n]*%\}",
    "<%": r"<%[=-]?\s*\w[^%\n]*%>",
    "${": r"\$\{\s*\w[^{}\n]*\}",
    "#{": r"#\{\s*\w[^{}\n]*\}",
    "{": r"(?<![{$#%\\])\{(?:[A-Za-z_]\w*(?:[.|]\w+)*|\d{1,2})\}(?!\})",
    "<<": rf"<<\s*{_NAME}\s*>>",
    "[[": rf"\[\[\s*(?:{_FIELDLIKE}|[a-z]+(?:_[a-z]+)+|[A-Z]+(?:_[A-Z]+)+)\s*\]\]",
    "@@": r"@@\w+@@",
    "$": r"(?<![\w$\\])\$[A-Za-z_][A-Za-z_]+\$(?![\w$])",
    # names of Python's own have two underscores too
    "__": rf"(?<!\w)__(?!name__)(?:(?-i:[A-Z][A-Z_]+)|{_FIELDLIKE})__(?!\w)|(?<![_＿])_{{4,}}(?![_＿])",
    "%": r"(?<![\w%])%[A-Za-z]{2}[A-Za-z_]+%(?!\w)|%\(\w+\)[sdf]|(?<![\w%])%[sd](?![\w%])",
    # not [text](link), nor the tags of bulletin boards
    "[": rf"\[(?:todo|tbd|tbc|fixme|insert|your|enter)\b[^\]\n]*\](?!\()|\[object object\]|\[(?!(?:the|of|here|no|your|id|code|quote|url|link|image|photo|video|event)\]){_FIELDLIKE}\](?!\()|\[[^\[\]\n]+ goes here\](?!\()",
    "tbd": r"(?<!\w)tbd\s?\([^)\n]+\)",
    "undefined": r"(?<![\w“\"«„‘'`.\-])(?<!\bis )(?<!\bare )(?<!\bwas )(?<!\bwere )(?<!\bbe )(?<!\ban )(?<!\bremains )(?<!\bleft )undefined(?![\w”\"»’'`\-(]|\.\w)"
    r"(?! (?:behaviou?rs?|variables?|index|offset|values?|symbols?|references?|functions?|methods?|propert|types?|terms?|constants?|names?|in\b|for\b|by\b|at\b|on\b|or\b|as\b|when\b|if\b|behavior))",
    "【": rf"【{_FIELDLIKE}】",
    "待补": r"<[^<>\n]+待补>",
    "待定": r"《[^《》\n]+待定》",
    "此处填写": r"[（(\[【]此处填写[^）)\]】\n]*[）)\]】]",
}
#: Placeholders that open before their mark: what opens them.
_OPENS = {"待补": "<", "待定": "《", "此处填写": "（([【"}
# Words of sentences that speak about placeholders instead of holding one.
_ABOUT = re.compile(
    r"(?i)\b(?:f-strings?|placeholders?|templates?|templating|variables?|syntax|delimiters?|interpolat\w+|printf|sprintf|format(?:ting)? strings?|jinja2?|mustache|"
    r"handlebars|literals?|escaped?|regex(?:es)?|regular expressions?|identifiers?|platzhalter|variablen?|syntaxe|plantillas?|marcador(?:es)?)\b|占位符|变量|模板|语法"
)
_END = re.compile(r"[.!?]\s|[。！？]")
_PAIRED = {"`": "`", "“": "”", "‘": "’", "«": "»", "„": "“", "「": "」", "『": "』", "'": "'"}


@lru_cache(1)
def _machine():
    import ahocorasick

    a = ahocorasick.Automaton()
    for w in {x.strip() for line in CUES.strip().split("\n") for x in line.split("|")} - {""}:
        a.add_word(w, (1, len(w), w))
    for m in _GRAMMAR:
        a.add_word(m, (0, len(m), m))
    a.make_automaton()
    return a, {m: re.compile(g, re.IGNORECASE) for m, g in _GRAMMAR.items()}


@lru_cache(1)
def _vocabulary() -> tuple[frozenset, re.Pattern]:
    known = set(WORDS.lower().split()) | _LOREM
    for line in CUES.strip().split("\n"):
        known |= {w for w in _WORD.findall(line) if not _HAN.search(w)}
    han = set(HAN_WORDS.split()) | {w for line in CUES.strip().split("\n") for w in line.split("|") if _HAN.search(w)}
    return frozenset(known), re.compile("|".join(map(re.escape, sorted(han, key=len, reverse=True))))


_LATIN = re.compile(r"[a-zà-ÿ0-9_]")
_SENTENCE = re.compile(r"[^\n.!?。！？]*(?:[.!?](?![\s\"'”’)\]}]|$)[^\n.!?。！？]*)*[.!?。！？]*")
# stack frames, log heads and bare codes count as covered, whatever names they hold
_FRAMES = re.compile(
    r"(?m)^[ \t]*File \".*\", line \d+.*$|^[ \t]*at [\w.$<>/]+ ?\(.*\)[ \t]*$|^[ \t]*(?:Caused by: )?[\w.]*\w(?:Error|Exception)(?::[^\n]*)?$|^[ \t]*\[?(?:ERROR|WARN(?:ING)?|FATAL|CRITICAL)\]?\b.*$|"
    r"^[ \t]*\d{4}-\d\d-\d\d[ T]\d\d:\d\d\S*\s+\[?(?:ERROR|WARN(?:ING)?|FATAL|CRITICAL)\b.*$"
)
_CODE = re.compile(r"<[^<>\n]+>|&[a-z]+;|https?://\S+|(?<![a-z0-9_/.\-])[a-z0-9_/.\-]+\.(?:html?|php|aspx?|jsp)\b|\b(?=[0-9a-f]*\d)[0-9a-f]{5,}\b|\b[0-9a-f]{6,}\b", re.IGNORECASE)
# What stands in a form that nobody filled in.
_EMPTY = "暂无 略 待补充 待定 待补 无 未填 n/a na none tbd null nil tba - -- — … …… ... ? x xx xxx".split()
_LINE = re.compile(r"[^:：\n]+[:：]\s*(.*)")


def _alone(text: str, lo: int, hi: int) -> bool:
    """Whether a rule stands alone on its line."""
    a, b = text.rfind("\n", 0, lo) + 1, text.find("\n", hi)
    return not text[a:lo].strip() and not text[hi : len(text) if b < 0 else b].strip()


def _mentioned(text: str, lo: int, hi: int) -> bool:
    """Whether the text speaks about the placeholder: it stands alone in quotation marks (a straight
    double quotation mark holds a value) or backticks, in a fenced block, or in a sentence about such things."""
    if lo and _PAIRED.get(text[lo - 1]) == text[hi : hi + 1]:
        return True
    if text.count("```", 0, lo) % 2 or text.count("`", text.rfind("\n", 0, lo) + 1, lo) % 2:
        return True
    start, end = text.rfind("\n", 0, lo) + 1, text.find("\n", hi)
    before = _END.split(text[start:lo])[-1]
    after = _END.split(text[hi : len(text) if end < 0 else end], maxsplit=1)[0]
    return _ABOUT.search(f"{before} {after}") is not None


def _repeats(flat: str) -> bool:
    """Whether one unit, of any length, stands four times in a row and makes up most of the letters, a
    heading before it and an ending after it left out."""
    n = len(flat)
    # a stretch that repeats over most of the text holds its middle and two periods from there
    for lo in (n // 2, n // 4):
        probe = flat[lo : lo + 8]
        at = lo
        c, short = None, []
        while True:
            at = flat.find(probe, at + 1)
            if at < 0 or 4 * (at - lo) > n:
                break
            p = at - lo
            # a multiple of a period whose run is too short has the same run; few others come round here
            if flat[lo : lo + p] != flat[at : at + p] or any(p % q == 0 for q in short):
                continue
            if c is None:
                c = np.frombuffer(flat.encode("utf-32-le", "replace"), dtype=np.uint32)
            off = np.flatnonzero(c[p:] != c[:-p])
            k = int(np.searchsorted(off, lo))
            a = int(off[k - 1]) + 1 if k else 0
            b = (int(off[k]) if k < len(off) else n - p) + p
            if a <= lo < b and b - a >= 4 * p and b - a >= COVERAGE * n and (p > 1 or n > 20):
                return True
            short.append(p)
    return False


def _unfilled(text: str) -> bool:
    """A form of two or more fields, no line beside them but a heading, and nothing in any field."""
    fields = others = 0
    for line in text.split("\n"):
        if not line.strip():
            continue
        m = _LINE.fullmatch(line.strip())
        if m is None:
            others += 1
        elif m.group(1).strip().lower() in _EMPTY:
            fields += 1
        else:
            return False
        if others > 1:
            return False
    return fields > 1


_LOREM, _LINKS = frozenset(LOREM), frozenset(LINKS)


def _formless(text: str, low: str) -> bool:
    """A form with no field filled in, one unit repeated over most of the text, words without links
    from a small stock, or keys struck at random."""
    if _unfilled(text):
        return True
    flat = re.sub(r"[\W\d_]+", "", low)
    if len(flat) < 12:
        return False
    if _repeats(flat):
        return True
    if _HAN.search(flat):
        return False
    words = _WORD.findall(low)
    if len(words) < 6:
        return False
    known = sum(len(w) for w in words if w in _LOREM)
    if known >= COVERAGE * len(flat) and sum(len(w) > 3 and w in _LOREM for w in words) >= 4:
        return True
    linked = sum(w in _LINKS for w in words)
    if len(words) >= 20 and linked <= 0.02 * len(words):
        # prose says few words often and many once; a stock of words comes round again and again
        counts = Counter(words)
        if len(counts) <= 3 * len(words) ** 0.5 and max(counts.values()) <= max(4, 4 * len(words) / len(counts)):
            return True
    if len(flat) >= 30 and flat.isascii() and linked <= 0.05 * len(words):
        # keys struck at random: few different letters from the home row and above, few vowels
        return len(set(flat)) <= 12 and sum(c in "asdfghjkl" for c in flat) > 0.5 * len(flat) and sum(c in "aeiou" for c in flat) < 0.35 * len(flat)
    return False


def _share(text: str, low: str, cues: list[tuple[int, int]]) -> float:
    """Share of the text's letters in notices, and in what stands around them on such pages."""
    known, han = _vocabulary()
    framed = [(m.start(), m.end()) for m in _FRAMES.finditer(text)]
    inside = np.zeros(len(text) + 1, dtype=bool)
    for lo, hi in framed:
        inside[lo:hi] = True
    gone = np.zeros(len(text) + 1, dtype=bool)
    for m in _CODE.finditer(low):
        gone[m.start() : m.end()] = True
    starts = np.array(sorted(lo for lo, _ in cues), dtype=np.int64)
    total = covered = 0
    told = bool(framed)
    rest: list[tuple[int, float, str]] = []
    for m in _SENTENCE.finditer(low):
        lo, hi = m.span()
        if lo == hi:
            continue
        letters = hit = 0
        for w in _WORD.finditer(low, lo, hi):
            if gone[w.start()]:
                continue
            letters += w.end() - w.start()
            if inside[w.start()] or w.group() in known or w.group().split("’")[0].split("'")[0] in known:
                hit += w.end() - w.start()
            elif _HAN.search(w.group()):
                hit += sum(len(x) for x in han.findall(w.group()))
                hit += sum(len(x) for x in re.findall(r"[a-zà-ÿ]+", w.group()) if x in known)
        if not letters:
            continue
        total += letters
        k = int(np.searchsorted(starts, lo))
        part = hit / letters
        if (k < len(starts) and starts[k] < hi and part >= NOTICE) or inside[lo]:
            told = True
            covered += letters if part >= FRAME or inside[lo] else hit
        else:
            rest.append((letters, part, low[lo:hi].strip()))
    if not told or not total:
        return 0.0
    again = Counter(x for _, _, x in rest)
    covered += sum(n for n, part, x in rest if part >= FRAME or again[x] > 1)
    return covered / total


def verdict(text: str | None) -> tuple[bool, float, str]:
    """(residue or not, share covered, what decided); a null or empty text is no residue."""
    if not text:
        return False, 0.0, ""
    machine, grammar = _machine()
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    cues: list[tuple[int, int]] = []
    for end, (kind, n, what) in machine.iter(low):
        lo, hi = end + 1 - n, end + 1
        if not kind:
            at = lo
            if (opens := _OPENS.get(what)) is not None:
                at = max(low.rfind(c, 0, lo) for c in opens)
                if at < 0:
                    continue
            m = grammar[what].match(text, at)
            if m and not (what == "__" and not m.group().strip("_＿") and _alone(text, m.start(), m.end())) and not _mentioned(text, m.start(), m.end()):
                return True, 0.0, "placeholder"
            continue
        if _LATIN.match(low[lo]) and lo and _LATIN.match(low[lo - 1]):
            continue
        if _LATIN.match(low[hi - 1]) and hi < len(low) and _LATIN.match(low[hi]):
            continue
        cues.append((lo, hi))
    share = 0.0
    if cues or "Exception" in text or "Error:" in text:
        share = _share(text, low, cues)
        if share >= COVERAGE:
            return True, share, "notice"
    if _formless(text, low):
        return True, 1.0, "filler"
    return False, share, ""


_OUT = "residue boolean, covered double, reason string"


def judge_residue(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, residue, covered, reason) of each row; texts of any length are read whole.

    `reason` is placeholder, notice or filler for residue and empty otherwise; `covered` is the share
    of the text's letters that notices and what belongs to them make up (0 where a placeholder decided). Null and
    empty texts are no residue. Rows with equal keys are judged each by their own text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [verdict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.bool_()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.string())],
                [key, "residue", "covered", "reason"],
            )

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, {_OUT}")
