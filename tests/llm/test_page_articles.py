"""Articles of web pages: templates inside them, class words, paths, raw elements."""
from starloom.llm import html_extract, html_pages


def texts_of(spark, bodies, host="h.org"):
    data = [(i, f"http://{host}/{i}", f"<html><body>{b}</body></html>") for i, b in enumerate(bodies)]
    got = html_extract.extract_text(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def test_template_text_leaves_articles(spark):
    words = ["ash", "oak", "elm", "fir"]
    bodies = [f"<main><p>More from us</p><article><p>The {w} is a tree that grows in our <a>wood</a> <a>too</a>.</p>"
              f"<p>{'again and again' if w < 'f' else 'once'}</p></article><p>Write to the <b>editor</b></p></main>"
              for w in words]
    assert texts_of(spark, bodies) == [
        f"The {w} is a tree that grows in our wood too.\n{'again and again' if w < 'f' else 'once'}" for w in words]


def test_copies_of_one_article_stay_whole(spark):
    bodies = [f"<article><p>{i}</p><p>One long article, three times.</p><p>And its end.</p></article>" for i in range(3)]
    assert texts_of(spark, bodies) == [f"{i}\nOne long article, three times.\nAnd its end." for i in range(3)]


def test_class_words_never_take_the_article():
    def text(body, **attributes):
        names = "".join(f' {k}="{v}"' for k, v in attributes.items())
        return html_extract.main_text(f"<html{names}><body{names}>{body}</body></html>", set(), set())

    article = "<p>The whole of it.</p><div class='ad'>buy</div><div class=cookie-notice>yes</div>"
    for name in ("has-sidebar", "no-comments", "sidebar", "comments", "header", "post category-social"):
        assert text(f"<main>{article}</main>", **{"class": name}) == "The whole of it."
        assert text("<p>The whole of it.</p>", id=name) == "The whole of it."
        for tag in ("article", "main", "div role=main"):
            assert text(f"<{tag} class='{name}'>{article}</{tag.split()[0]}>") == "The whole of it."
            assert text(f"<div class='{name}'><div><{tag}>{article}") == "The whole of it."
            assert text(f"<main><div class='{name}'><{tag}>{article}") == "The whole of it."
        assert text(f"<div class='{name}'><p>The whole of it.</p></div>") == "The whole of it."
    comments = "<section class='comments'><article><p>Nice!</p></article><article><p>So so.</p></article></section>"
    assert text(f"<article>{article}{comments}</article>") == "The whole of it."
    assert text(f"<article>{article}</article>{comments}<div class=site-footer>me</div>") == "The whole of it."
    assert text(f"<div>The whole of it.</div>{comments}<div class=comment-list>me</div>") == "The whole of it."


def test_articles_named_by_page_stay(spark):
    words = ["ash", "oak", "elm", "fir"]
    teaser = "<section><article class=teaser><p>Read {}</p></article></section>"
    for tag in ("<article id='post-{0}' class='post-{0} category-{1}'>", "<div id=p{0}><article class='{1}'>",
                "<div class='{1}'><article>"):
        bodies = [tag.format(i, w) + f"<p>The {w} is a tall tree.</p></article>" + teaser.format(w)
                  for i, w in enumerate(words)]
        got = texts_of(spark, bodies)
        assert all(f"The {w} is a tall tree." in t.split("\n") for w, t in zip(words, got))


def test_paths_without_ids_and_numbers():
    pages = [html_pages.read_page(f"<body id=b{i} class='page-{i}'><article id=a{i} class='post-{i} tag-{i}x'>"
                                  f"<p class='wide css-{i}x9 tag-{'abc'[i]}' id=p{i}>x") for i in range(3)]
    assert pages[0].paths == pages[1].paths == pages[2].paths
    assert list(pages[0].paths) == [">body", ">body>article", ">body>article>p.css-#.wide"]


def test_raw_elements_by_whole_name():
    for mark in ("<svg class=i />", "<svg/>", "<SVG viewBox='0 0 1 1' />", "<svg><path d='M0' /><text>no</text></svg >",
                 "<title-bar></title-bar>", "<svg-icon name=a>", "<script-x>", "<script>no</script x>"):
        assert html_extract.main_text(f"<article>{mark}<p>All of it.</p></article>", set(), set()) == "All of it."
    assert html_extract.main_text("<article><script src=a /><p>no</p></script>yes", set(), set()) == "yes"


def test_headings_between_own_texts_stay(spark):
    bodies = [f"<article><p>Share this page</p><h1>Soup {i}</h1><h2>Ingredients</h2><p>{i} leeks</p><h2>Method</h2>"
              f"<p>Stir.</p><p>{f'Cook for {i} minutes. ' * 9}</p><p>Copyright of the cook</p></article>" for i in range(6)]
    cook = [f"Cook for {i} minutes. " * 9 for i in range(6)]
    assert texts_of(spark, bodies) == [
        f"Soup {i}\nIngredients\n{i} leeks\nMethod\nStir.\n{cook[i].strip()}" for i in range(6)]
    # a heading that leads up to the article's first own text, and one of pages without an article
    bodies = [f"<article><p>Share</p><h2>Today</h2><p>{i} leeks {i} {'x' * 30}</p><p>Bye</p></article>" for i in range(6)]
    assert texts_of(spark, bodies, "a.org") == [f"Today\n{i} leeks {i} {'x' * 30}" for i in range(6)]
    bodies = [f"<div><p>Share</p><h2>Ingredients</h2><p>{i} leeks</p><h3>See also</h3><p>Bye</p></div>" for i in range(6)]
    assert texts_of(spark, bodies, "b.org") == [f"Ingredients\n{i} leeks" for i in range(6)]


def test_comments_longer_than_the_post_stay_out():
    comment = "<section class='{}'><article class='comment-body'><p>" + "I think that this is so. " * 9 + "</article></section>"
    for name in ("comments", "user-comments", "comment-list"):
        inside, beside = (f"<{x}>" for x in ("article", "main"))
        for tag in (inside, beside):
            end = tag.replace("<", "</")
            assert html_extract.main_text(f"{tag}<p>Short post.</p>{comment.format(name)}{end}", set(), set()) == "Short post."
            assert html_extract.main_text(f"{tag}<p>Short post.</p>{end}{comment.format(name)}", set(), set()) == "Short post."
        assert html_extract.main_text(f"<div><p>Short post.</p></div>{comment.format(name)}", set(), set()) == "Short post."


def test_names_and_hidden_parts_inside_articles():
    for mark in ("class=google-ads", "class=adsbygoogle", "class='user-comments'", "style='display:none'",
                 "style=\"color:red; DISPLAY : none\"", "style='visibility:hidden'", "hidden", "id=google_ads_1"):
        assert html_extract.main_text(f"<article><p>All.</p><div {mark}><p>no</p></div></article>", set(), set()) == "All."
    for tag in ("video", "audio", "canvas", "object"):
        assert html_extract.main_text(f"<article><p>All of</p><{tag}>no player</{tag}><p>it.", set(), set()) == "All of\nit."


def brute_template(pages):
    """(containers, static) of one host's pages by explicit occurrence vectors."""
    counts, kinds, parents, shares = {}, {}, {}, {}
    for i, source in enumerate(pages):
        page = html_pages.read_page(source)
        seen = {}
        for path, n in page.paths.items():
            seen[(path, "")] = n
            kinds[(path, "")] = "container" if path in page.containers else "element"
            parents[(path, "")] = path.rpartition(">")[0]
        for _, path, text, inside, _ in page.texts:
            if not inside and (words := " ".join(text.split())):
                seen[(path, words)] = seen.get((path, words), 0) + 1
                kinds.setdefault((path, words), "text")
                parents[(path, words)] = path
        blocks = html_extract._blocks(page.texts)
        size = sum(len(w) for _, w in blocks.values())
        for path, words in blocks.values():
            key = (path, words)
            seen[key] = seen.get(key, 0) + 1
            kinds[key], parents[key] = "block", path
        for key, n in seen.items():
            counts.setdefault(key, {})[i] = n
            if kinds[key] == "block":
                shares[key] = shares.get(key, 0) + 1000 * len(key[1]) * n // size
    often = {k: c for k, c in counts.items() if len(c) >= 3}
    most = max(map(len, often.values()), default=0)
    often = {k: c for k, c in often.items() if 2 * len(c) >= most}
    nested = {k: c for k, c in often.items()
              if not parents[k] or len(often.get((parents[k], ""), ())) >= len(c)}
    classes = {}
    for k, c in nested.items():
        classes.setdefault(tuple(sorted(c.items())), []).append(k)
    containers, static = set(), set()
    for vector, keys in classes.items():
        if any(kinds[k] in ("element", "container") for k in keys):
            containers |= {html_extract._token(*k) for k in keys if kinds[k] == "container"}
            static |= {html_extract._token(*k) for k in keys if kinds[k] == "text"}
            if sum(shares.get(k, 0) for k in keys) <= len(vector) * html_extract.MAX_SHARE:
                static |= {html_extract._token(*k) for k in keys if kinds[k] == "block"}
    return containers, static


def test_templates_match_brute_force(spark):
    import random
    rnd = random.Random(6)
    hosts = {}
    for h in range(6):
        menu = "".join(f"<li>m{j}</li>" for j in range(rnd.randint(1, 4)))
        frame = [f"<p>frame {j} of {h}</p>" for j in range(4)]
        for i in range(rnd.randint(2, 9)):
            own = "".join(f"<p>{rnd.choice(['same', 'own'])} {rnd.randint(0, 3 if j else 99)}</p>" for j in range(rnd.randint(0, 5)))
            parts = [x for x in frame if rnd.random() < 0.8]
            body = f"<nav><ul>{menu}</ul></nav><div><p>top</p></div>" + rnd.choice(["<article>", "<main>", "<div class='b c'>"])
            hosts.setdefault(h, []).append(f"<html><body>{body}{''.join(parts[:2])}{own}{''.join(parts[2:])}")
    data = [(1000 * h + i, f"http://h{h}.org/{i}", source) for h, some in hosts.items() for i, source in enumerate(some)]
    pages = spark.createDataFrame(data, "__page long, __url string, __html string")
    got = {r.host: (set(r.containers), set(r.static)) for r in html_extract.host_templates(pages).collect()}
    for h, some in hosts.items():
        containers, static = got.get(f"h{h}.org", (set(), set()))
        want = brute_template(some)
        assert (containers, static) == want, h


def test_a_very_long_page_is_read_whole():
    source = "<article>" + "".join(f"<p>w{i} and more</p>" for i in range(60_000)) + "</article>"
    assert html_extract.main_text(source, set(), set()).count("\n") == 59_999
