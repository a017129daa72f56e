"""Pages, forms, filler and real content as they occur in the open, none of it taken from the test tables."""

from inkframe.llm.residue import verdict

PAGES = [
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.",
    "Vestibulum ante ipsum primis in faucibus orci luctus et ultrices posuere cubilia curae. Praesent sodales, quam vitae gravida interdum, ex mi bibendum enim, sit amet tristique mi quam vel odio. Donec non magna rutrum, pellentesque augue eu, sagittis velit.",
    "404. That’s an error.\nThe requested URL was not found on this server. That’s all we know.",
    "Not Found\nThe requested URL /index.php was not found on this server.\nApache/2.4.41 (Ubuntu) Server at example.com Port 80",
    "502 Bad Gateway\nnginx/1.18.0", "403 Forbidden\nYou don't have permission to access this resource.", "503 Service Temporarily Unavailable\nThe server is temporarily unable to service your request due to maintenance downtime or capacity problems. Please try again later.",
    "Sorry, you have been blocked\nYou are unable to access this website. This website is using a security service to protect itself from online attacks.",
    "Checking your browser before accessing the site.\nThis process is automatic. Your browser will redirect to your requested content shortly.\nPlease allow up to 5 seconds…\nDDoS protection by Cloudflare\nRay ID: 7a1b2c3d4e5f",
    "Our systems have detected unusual traffic from your computer network. Please verify that you are not a robot.", "Please complete the security check to access this page.", "This account has been suspended.\nContact your hosting provider for more information.",
    "We're sorry but this app doesn't work properly without JavaScript enabled. Please enable it to continue.", "You need to enable JavaScript to run this app.", "JavaScript is disabled in your browser. Please enable JavaScript to proceed.", "Your browser does not support JavaScript!",
    "Cookies are required to use this site. Please enable cookies in your browser settings and try again.",
    "Für die Nutzung dieser Website muss JavaScript aktiviert sein. Bitte aktivieren Sie JavaScript in Ihrem Browser.", "Por favor, habilite JavaScript en su navegador para ver esta página.", "Veuillez activer les cookies et JavaScript pour accéder à ce site.",
    "Seite nicht gefunden\nDie von Ihnen gesuchte Seite existiert nicht. Zurück zur Startseite", "Página no encontrada\nLo sentimos, la página que busca no existe.", "Erreur 404 : la page que vous recherchez est introuvable.", "该页面无法访问", "抱歉，您访问的页面不存在或已被删除。", "服务器错误，请稍后再试。", "请开启浏览器的JavaScript功能后继续访问。",
    "Access Denied\nYou don't have permission to access this page.\nReference #18.5f2e1102.1623456789", "This site can’t be reached. The server took too long to respond. Connection timed out.", "Internal Server Error\nThe server encountered an internal error or misconfiguration and was unable to complete your request.",
    "Your session has expired. Please log in again.", "Too many requests. Please slow down and try again in a few minutes.", "Error establishing a database connection", "Warning: mysql_connect(): Access denied for user 'root'@'localhost' (using password: YES) in /var/www/html/db.php on line 12",
    'Traceback (most recent call last):\n  File "/app/main.py", line 10, in <module>\n    run()\n  File "/app/main.py", line 6, in run\n    raise KeyError("user")\nKeyError: \'user\'', "java.lang.NullPointerException\n\tat com.acme.Foo.bar(Foo.java:42)\n\tat com.acme.Main.main(Main.java:7)", '{"status": 500, "error": "Internal Server Error", "message": "An unexpected error occurred"}',
    "This page is under construction. Please check back soon!", "This video is no longer available.", "Sorry, this content is not available in your region.", "The page you are looking for has been moved or deleted.", "Страница не найдена. Ошибка 404.", "ページが見つかりません",
]
FILLER = [
    "Your text here. Your text here. Your text here.", "Insert your content here.", "This is placeholder text. Replace this text with your own content.", "Dies ist ein Blindtext. Hier steht Ihr Text.", "Texto de ejemplo. Escriba su texto aquí.", "test test test test test test test", "asdf asdf asdf asdf asdf asdf", "blah blah blah blah blah blah blah",
    "sdkfjh skdjfh lskdjf skjdf lsdkjf sldkfj slkdfj", "Name: N/A\nAddress: N/A\nPhone: -\nEmail: none", "这里是占位文字，请输入您的内容。", "mavor telis dunak pir. telis mavor sulen dunak mavor. pir sulen telis mavor dunak. sulen pir telis telis mavor dunak pir mavor. telis sulen dunak pir mavor.",
]
PLACES = [
    "Dear [Customer Name],\nthank you for your order [ORDER NUMBER] of [DATE].", "I write on behalf of [Company Name Here] about the post.", "Hello {{first_name}}, welcome back to our little town!", "Sehr geehrte Frau [Nachname], wir danken Ihnen für Ihr Schreiben.", "Dear %FIRSTNAME%, your parcel has left our house.", "The ${product.name} is the best choice for your garden.",
    "Signed this day by [insert name here] in the town hall.", "Hi <%= user.name %>, your book is ready.", "Contact: [Your Email Address]", "The winner is [TBD] and will be told next week.", "Le soussigné [Nom], né à [Ville], déclare ce qui suit.", "Hello $USERNAME$, nice to see you.", "Price of the item: [object Object]", "尊敬的【姓名】：您好，您的书已经到了。", "{{#if user}}Welcome{{/if}} to the club of old readers.",
    "My name is ________ and I live in the old mill.", "Dear {recipient_name}, we met last spring in the harbour.",
]
REAL = [
    "In f-strings, use {name} to insert a value into the text.", "Write `{{ user }}` in the template and the engine fills it in.", "The placeholder {0} stands for the first argument of the call.", "A Jinja template contains {{ name }} where the value goes.", "```python\nprint('{name}')\n```\nThis prints the name in braces.", "The set {a, b, c} has three members, and [a, b] is an interval.",
    "Error 404 was the name of their band; they played in Leeds for three years and broke up over a broken amplifier.", "She tried the handle. Access denied, said the panel, and the red lamp went on. Behind the door somebody laughed, and the train rolled out of the station without her.", "JavaScript is a programming language that runs in browsers. It was written in ten days in 1995 and has been standardized since 1997 as ECMAScript.",
    "Cookies: mix butter, sugar and two eggs, add flour, and bake for twelve minutes at 180 degrees.", "The HTTP status code 503 tells a client that a service is overloaded or down for maintenance; proxies may add a Retry-After field so that crawlers come back at a better time.", "Lorem ipsum is a corrupted passage of Cicero's De finibus bonorum et malorum of 45 BC, used by printers since the 1500s to fill a page before the words exist. Designers like it because it does not distract.",
    "The behaviour of a program that divides by zero is undefined behavior in C.", "The slope of a vertical line is undefined.", "He signed the letter [sic] and left [laughter].", "[Verse 1]\nI walked along the river in the rain\n[Chorus]\nAnd the river ran to sea", "See [here](https://example.org) and [title](b.html) for the whole story.", "Row, row, row your boat, gently down the stream, merrily, merrily, merrily, merrily, life is but a dream.",
    "Name: Ada\nHome: London\nBorn: 1815", "Gallia est omnis divisa in partes tres, quarum unam incolunt Belgae, aliam Aquitani, tertiam qui ipsorum lingua Celtae, nostra Galli appellantur.", "Arma virumque cano, Troiae qui primus ab oris Italiam fato profugus Laviniaque venit litora, multum ille et terris iactatus et alto vi superum.", "Kun hän saapui kylään, oli jo pimeä. Vanha mylly seisoi yhä joen rannalla, ja sen ikkunoista näkyi valoa.",
    "The total was $5 and then $7, 15% too much, from page %4 to %9.", "Der Fehler lag beim Schaffner, der die Tür nicht geschlossen hatte. Der Zug fuhr trotzdem weiter bis nach Kassel und kam eine Stunde zu spät an.", "他打开浏览器，想找那家书店的网址，却怎么也想不起名字，只好合上电脑，去街角买了一份报纸。", "La página estaba rota por el medio, y nadie en la casa recordaba quién la había arrancado aquella noche de invierno.", "We could not be found, she thought, not here under the bridge, not by anyone who did not know the tide.",
    "a = [0]\nb = a[i]\nc = {x for x in a}", "The maintenance of the lighthouse was Anna's task. She cleaned the lamp each evening, and the ships came home safely all winter long.", "“Please verify the seal,” said the clerk. The merchant took the letter to the window and turned it to the light.", "IF YOU CAN READ THIS, YOU ARE TOO CLOSE", "Too many cooks spoil the broth.", "Not found in any library, the second folio lay under the stairs of the rectory until 1911, when the new vicar, a careful man, had the floor taken up.",
    "To enable cookies in Firefox, open the settings, choose Privacy, and tick the box for third-party cookies. Then restart the program. The change holds for all windows, but not for private ones, where the choice is forgotten when they close.", "f(x) = { x if x > 0; 0 otherwise }", "Python dict: {'a': 1, 'b': 2}", "On __init__ and __main__: modules that Python treats in a way of their own.", "He marked 100%, then wrote %d in the margin of the C primer beside the format string printf(\"%s\").",
]


def test_open_pages():
    found = [t for t in PAGES + FILLER + PLACES if verdict(t)[0]]
    wrong = [t for t in REAL if verdict(t)[0]]
    assert len(found) / len(PAGES + FILLER + PLACES) >= 0.9, [t for t in PAGES + FILLER + PLACES if not verdict(t)[0]]
    assert len(found) / (len(found) + len(wrong)) >= 0.9 and len(wrong) <= 0.1 * len(REAL), wrong


def test_length_decides_nothing():
    for n in (2, 60, 100, 5000):
        assert verdict("Field: n/a\n" * n)[::2] == (True, "filler")
    assert verdict("A tale of the town. " * 3 + "{{ " + "customer_name_" * 40 + " }}")[2] == "placeholder"
    assert verdict("[TODO: " + "write the ending of this chapter " * 20 + "]")[2] == "placeholder"


def test_hard_texts_end_soon():
    import time

    start = time.perf_counter()
    for t in ("[" + "username" * 4000 + "!]", "\n" * 200_000 + "error", "错误" + "在门前的树下" * 60_000, "ab" * 100_000 + "error c", "error " + "a.b/" * 80_000, "{{ " * 50_000, "fofobar" * 9 + "x" * 200_000 + "y", "<" * 90_000 + "error"):
        verdict(t)
    assert verdict("fofobar " * 40)[0]
    assert time.perf_counter() - start < 20
