"""Main text of web pages as the maximum-scoring subsequence of their words and tags.

A page is a sequence of tags and of runs of words. A word scores positive: the probability,
by a logistic regression on the open elements around it, that it is main text. A tag scores
negative: the logarithm of the share of its kind that stands within the main text. One linear
scan finds the contiguous region with the highest sum. Where the region stands in an element
that names itself the article (or, without one, in a container that speaks for main text),
it takes in the rest of that element, so that a short piece behind an advert is not lost.
Words of the region whose elements speak against main text (an advert or a form amid the
article) are left out.

The weights come from labelled pages: the examples that ``example_pages`` puts together, whose
words say whether they are main text, and a sample of the pages at hand that hold exactly one
element ``article`` or ``main``, whose words inside it are taken as main text. The sample holds
about ``SAMPLE_PAGES`` different pages, chosen by a hash of the whole html, and at most
``SAMPLE_CONTEXTS`` kinds of places.

Reading follows the usual rules of the markup: raw text in scripts and styles, comments to
their end or the page's, elements closed by others (p, li, cells), unclosed ones and stray end
tags. White space is what Unicode calls so. ``br`` and elements that are not inline part blocks.

Defined results: null and empty html, and pages without main text, give an empty text. Repeated
rows are extracted each. Pages of any length are read whole, in time linear in their length
but for hostile nesting. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES, SAMPLE_CONTEXTS = 2000, 5000
# Weight of the squared weights in the regression.
RIDGE = 0.02
# A container speaks for main text if its own features add as much to the log-odds.
CONTAINER = 1.0
# Factors of the tags' scores that are tried on the examples.
SCALES = (1.0, 0.5, 0.25, 0.1)
# Features by which an element names itself the article, or the main part.
NAMED = (frozenset(["article", "itemprop=articlebody"]), frozenset(["main", "role=main"]))

# Kinds of elements of the markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr "
    "output progress q rp rt ruby s samp small span strike strong sub sup time tt u var img input "
    "wbr math picture source".split()
)
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
SILENT = frozenset(
    "head script style title textarea iframe noembed noframes noscript template svg object canvas "
    "audio video select datalist button".split()
)
IN_HEAD = frozenset("title meta link style script base noscript template".split())
CLOSED_BY = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}

TAG = re.compile(
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
TELLING = re.compile(r"class|id|role|itemprop|hidden|style", re.IGNORECASE)
CAMEL = re.compile(r"([a-z])([A-Z])")
LETTERS = re.compile(r"[a-z]+")


LINKS, INNER = "~links", "~inner-header"


def features_of(name: str, attributes: str) -> tuple[str, ...]:
    """What an element tells: its name, the words of its class and id, its role."""
    # Every page has html and body, written or not: their names tell nothing.
    found = {} if name in ("html", "body") else {name: None}
    if TELLING.search(attributes):
        for m in ATTRIBUTE.finditer(attributes):
            key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
            if key in ("class", "id"):
                for word in LETTERS.findall(CAMEL.sub(r"\1-\2", value).lower()):
                    found["." + word] = None
            elif key in ("role", "itemprop"):
                found[f"{key}={value.strip().lower()}"] = None
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                found["hidden"] = None
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
                found["hidden"] = None
    return tuple(found)


@dataclass
class Page:
    """Tags and runs of a page in order.

    ``events`` holds ("tag", features) and ("run", block, text, place); a place is the set of
    open features or, with weights at hand, their sum; a block whose words all stand in links
    has the feature ``LINKS`` besides. ``elements`` holds (name, features,
    first event, event behind the last one) of elements that may hold a whole article.
    """

    events: list = field(default_factory=list)
    elements: list = field(default_factory=list)
    unlinked: set = field(default_factory=set)  # blocks with words outside links


class Reader:
    """Reads one page; ``weights`` of features, or None to note the open features."""

    def __init__(self, weights: dict[str, float] | None, known: dict) -> None:
        self.weights, self.known = weights, known
        self.page, self.stack, self.names = Page(), [], Counter()
        self.open, self.sum, self.silent, self.block = Counter(), 0.0, 0, 0

    def push(self, name: str, features: tuple[str, ...]) -> None:
        self.stack.append((name, features, len(self.page.events)))
        self.names[name] += 1
        self.silent += name in SILENT
        for f in features:
            self.open[f] += 1
            if self.weights is not None and self.open[f] == 1:
                self.sum += self.weights.get(f, 0.0)

    def pop(self) -> None:
        name, features, begin = self.stack.pop()
        self.names[name] -= 1
        self.silent -= name in SILENT
        for f in features:
            self.open[f] -= 1
            if self.open[f] == 0 and self.weights is not None:
                self.sum -= self.weights.get(f, 0.0)
        if name not in INLINE:
            self.page.elements.append((name, features, begin, len(self.page.events)))

    def close(self, wanted: Iterable[str], stops: Iterable[str] | None) -> None:
        """Pop through the nearest of ``wanted``, unless one of ``stops`` (None: a block) is nearer."""
        if not any(self.names[w] for w in wanted):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name in wanted:
                while len(self.stack) > i:
                    self.pop()
                return
            if (stops is None and name not in INLINE) or (stops is not None and name in stops):
                return

    def start(self, name: str, attributes: str) -> None:
        features = self.known.get((name, attributes))
        if features is None:
            features = features_of(name, attributes)
            if len(self.known) < 20_000 and len(attributes) < 200:
                self.known[name, attributes] = features
        if self.stack and self.stack[-1][0] == "head" and name not in IN_HEAD:
            self.pop()
        if name in ("html", "body") and self.names[name]:
            return
        if name not in INLINE:
            self.close(("p",), None)
            if name in CLOSED_BY:
                self.close(*CLOSED_BY[name])
            self.block += 1
        if name == "header" and (self.names["article"] or self.names["main"]):
            features = (INNER, *features[1:])  # the article's own head, not the page's
        self.page.events.append(("tag", features))
        if name not in VOID:
            self.push(name, features)

    def end(self, name: str) -> None:
        if name in ("html", "body") or name in VOID:
            return
        if name not in INLINE:
            self.block += 1
        if self.names[name]:
            features = next(e[1] for e in reversed(self.stack) if e[0] == name)
            self.close((name,), None if name in INLINE else ())
            self.page.events.append(("tag", features))

    def text(self, raw: str) -> None:
        if self.silent or not raw:
            return
        place = frozenset(f for f, n in self.open.items() if n) if self.weights is None else self.sum
        text = entities.unescape(raw) if "&" in raw else raw
        self.page.events.append(("run", self.block, text, place))
        if not self.names["a"] and not text.isspace():
            self.page.unlinked.add(self.block)

    def read(self, html: str) -> Page:
        at, size = 0, len(html)
        while at < size:
            mark = html.find("<", at)
            if mark < 0:
                self.text(html[at:])
                break
            following = html[mark + 1 : mark + 2]
            if not (following.isascii() and following.isalpha()) and following not in ("/", "!", "?"):
                # A lone "<" is text; the run goes on to the next one.
                more = html.find("<", mark + 1)
                more = size if more < 0 else more
                self.text(html[at:more])
                at = more
                continue
            self.text(html[at:mark])
            tag = TAG.match(html, mark)
            if tag:
                at, name = tag.end(), tag.group(2).lower()
                if tag.group(1):
                    self.end(name)
                    continue
                self.start(name, tag.group(3))
                if name in RAW:
                    close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(html, at)
                    at = close.start() if close else size
            elif html.startswith("<!--", mark):
                close = html.find("-->", mark + 4)
                if html.startswith(("<!-->", "<!--->"), mark):
                    close = html.find(">", mark + 4) - 2
                at = size if close < 0 else close + 3
            else:
                close = html.find(">", mark)
                at = size if close < 0 else close + 1
        while self.stack:
            self.pop()
        events, weigh = self.page.events, self.weights is not None
        for i, event in enumerate(events):
            if event[0] == "run" and event[1] not in self.page.unlinked:
                place = event[3] + self.weights.get(LINKS, 0.0) if weigh else event[3] | {LINKS}
                events[i] = (*event[:3], place)
        return self.page


# Class names and ids of the labelled examples. "no" marks what is not main text.
NO_NAMES = (
    "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager header site-header page-header masthead "
    "top-bar topbar toolbar logo branding footer site-footer page-footer footer-content copyright legal colophon sidebar "
    "side-bar sidebar-content aside widget widget-area related related-posts related-articles recommended recommendations "
    "more-stories trending popular latest-news teaser ad ads adbox ad-slot ad-content ad-container advert adverts "
    "advertisement advertising adsbygoogle sponsored sponsor promo promotion banner top-banner cookie cookies cookie-banner "
    "cookie-notice cookie-consent consent consent-banner gdpr privacy-notice notice notices notification alert popup modal overlay "
    "comments comment comment-list comment-body comment-content commentlist reader-comments user-comments disqus-thread "
    "discussion responses replies reply reviews newsletter newsletter-signup subscribe subscription signup sign-up login "
    "login-form search search-form searchbox share sharing share-buttons social social-links social-media tags tag-list "
    "skip-link skip toc-menu paywall-notice disclaimer follow-us feedback contact-form poll rating"
).split()
YES_NAMES = (
    "content main-content page-content article article-body article-content article-text post post-body post-content "
    "entry entry-content story story-body text body-text main body blog-post post-title entry-title "
    "wrapper container layout row column inner section content-wrapper"
).split()
YES_OPENINGS = (
    "<article>", "<main>", "<main><article>", '<div role="main">', '<div itemprop="articleBody">', "<div>", "<section>",
    "", "<table><tr><td>", "<table><tr><td><a href='/'>no</a></td><td>", "<article><div>", "<article><section>", "<div><div><div>",
)
NO_ELEMENTS = (
    "<nav><ul><li><a href='/'>no</a></li><li><a href='/'>no no</a></li></ul></nav>",
    "<nav><a href='/'>no</a> <a href='/'>no</a></nav>", "<header><h1>no</h1><p>no no</p></header>",
    "<header><a href='/'>no</a><nav><a href='/'>no</a></nav></header>", "<footer><p>no no</p><ul><li><a href='/'>no</a></li></ul></footer>",
    "<header><h1><a href='/'>no</a></h1></header>", "<header><div>no</div><p>no</p></header>", "<header><h2>no</h2></header>",
    "<footer>no no</footer>", "<aside><h2>no</h2><p>no no</p><ul><li><a href='/'>no</a></li></ul></aside>", "<aside>no</aside>",
    "<form><label>no</label><p>no</p><input></form>", "<form><fieldset><legend>no</legend>no</fieldset></form>", "<menu><li>no</li></menu>",
    "<ul><li><a href='/'>no</a></li><li><a href='/'>no</a></li></ul>", "<p><a href='/'>no</a> <a href='/'>no</a></p>", "<dialog><p>no</p></dialog>", "<div hidden><p>no</p></div>",
    "<div role='navigation'><a href='/'>no</a></div>", "<div role='banner'><p>no</p></div>", "<div role='contentinfo'><p>no</p></div>",
    "<div role='complementary'><p>no</p></div>", "<div role='search'><p>no</p></div>", "<div role='alert'><p>no</p></div>",
    "<div role='dialog'><p>no</p></div>", "<section id='comments'><h2>no</h2><article class='comment'><p>no no</p></article></section>",
    "<section class='comments'><article><header>no</header><p>no no</p><footer>no</footer></article></section>",
)
YES_BODIES = (
    "<h1>yes</h1><p>yes yes yes</p><p>yes</p>", "<p>yes <a href='/'>yes</a> yes</p><ul><li>yes</li><li><a href='/'>yes</a></li></ul>",
    "<h2>yes</h2><blockquote><p>yes</p></blockquote><pre><code>yes</code></pre>", "<table><tr><th>yes</th></tr><tr><td>yes</td></tr></table>",
    "<figure><img><figcaption>yes</figcaption></figure><p><b>yes</b> <em>yes</em></p>", "yes yes<br>yes<div>yes</div>",
    "<ol><li><p>yes</p></li></ol><dl><dt>yes</dt><dd>yes</dd></dl><h3>yes</h3><span>yes</span>",
)


def example_pages() -> Iterator[str]:
    """Labelled pages: every word is "yes" or "no". Each container of main text, each kind of
    other element and each body occurs, the others before, after and amid the main text."""
    others = list(NO_ELEMENTS)
    for i, name in enumerate(NO_NAMES):
        inner = ("<p>no no</p>", "no", "<ul><li><a href='/'>no</a></li></ul>", "<h3>no</h3><p>no</p>", "<div><p>no</p></div>")
        for k in range(3):
            tag = ("div", "section", "div", "ul", "div", "aside", "span")[(i + k) % 7]
            others.append(f"<{tag} {'id' if k == 1 else 'class'}='{name}'>{inner[(i + k) % 5]}</{tag}>")
    openings = list(YES_OPENINGS)
    openings += [f"<{t} {a}='{n}'>" for n in YES_NAMES for t, a in (("div", "class"), ("div", "id"), ("section", "class"))]
    for i, opening in enumerate(openings * 6):
        pick = [others[(i * 11 + k * 37) % len(others)] for k in range(7)]
        bodies = [YES_BODIES[(i + k) % len(YES_BODIES)] for k in range(3)]
        title = "<h1>yes</h1>"
        if i % 3 == 1 and opening.startswith(("<article", "<main")):
            title = ("<header><h1>yes</h1><p>yes</p></header>", "<header><h1>yes</h1></header>", "<header>yes</header>")[i // 3 % 3]
        closing = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)) if f"</{t}>" not in opening or t == "td")
        outer = ("", "<div id='page'>", "<div class='wrapper'><div class='container'>")[i % 3]
        page = (
            f"<html><head><title>no</title></head><body>{outer}{pick[0]}{pick[1]}{pick[2]}{opening}{title}{bodies[0]}"
            f"{pick[3]}{bodies[1]}{pick[4]}{bodies[2]}{closing}{pick[5]}{pick[6]}</body></html>"
        )
        yield page.replace("yes", "yes" + " yes" * (i % 12)).replace("no<", "no" + " no" * (i % 5) + "<")


@dataclass
class Weights:
    place: dict[str, float]  # log-odds of an open feature
    base: float
    tag: dict[str, float]  # negative score of a tag with a feature

    def scaled(self, factor: float) -> Weights:
        return Weights(self.place, self.base, {f: factor * k for f, k in self.tag.items()})


def wrong_examples(weights: Weights) -> int:
    """Examples whose text is not read as it is labelled."""
    known: dict = {}
    read = ((page, main_text(page, weights, known).split()) for page in example_pages())
    return sum("no" in words or len(words) != page.count("yes") for page, words in read)


def label_by_words(page: Page) -> list[tuple[int, bool]]:
    return [(i, "yes" in e[2]) for i, e in enumerate(page.events) if e[0] == "run" and e[2].split()]


def label_by_element(page: Page) -> list[tuple[int, bool]]:
    """Runs of a page that holds one element ``article`` or else one ``main``; none otherwise."""
    for name in ("article", "main"):
        found = [e for e in page.elements if e[0] == name]
        if len(found) == 1:
            _, _, begin, end = found[0]
            return [(i, begin <= i < end) for i, e in enumerate(page.events) if e[0] == "run" and e[2].split()]
        if found:
            break
    return []


def tally(page: Page, labels: list[tuple[int, bool]]) -> set[tuple[str, str, bool]]:
    """(kind, key, label) of a labelled page, each once: places of runs, features of tags."""
    out = {("place", " ".join(sorted(page.events[i][3])), label) for i, label in labels}
    inside = [i for i, label in labels if label]
    if inside:
        for i, event in enumerate(page.events):
            if event[0] == "tag":
                out |= {("tag", f, inside[0] < i < inside[-1]) for f in event[1]}
    return out


def fit(counted: list[tuple[str, str, bool, float]]) -> Weights:
    """Logistic regression on places (Newton's method) and shares of tags."""
    places = [(set(key.split()), label, n) for kind, key, label, n in counted if kind == "place"]
    names = sorted({f for open_, _, _ in places for f in open_})
    at = {f: i + 1 for i, f in enumerate(names)}
    x = np.zeros((len(places), len(names) + 1))
    x[:, 0] = 1
    for i, (open_, _, _) in enumerate(places):
        x[i, [at[f] for f in open_]] = 1
    y = np.array([label for _, label, _ in places], float)
    n = np.array([n for _, _, n in places])
    w = np.zeros(x.shape[1])
    ridge = np.full(len(w), RIDGE * max(1.0, n.sum() / 1000))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - ridge * w
        curve = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    inside, total = Counter(), Counter()
    for kind, key, label, m in counted:
        if kind == "tag":
            total[key] += m
            inside[key] += m * label
    tag = {f: float(np.log((inside[f] + 1) / (total[f] + 2))) for f in total}
    fitted = Weights(dict(zip(names, w[1:].tolist(), strict=True)), float(w[0]), tag)
    return min((fitted.scaled(k) for k in SCALES), key=wrong_examples)


def examples() -> Counter:
    counted: Counter = Counter()
    for html in example_pages():
        page = Reader(None, {}).read(html)
        counted.update(tally(page, label_by_words(page)))
    return counted


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> Weights:
    """Weights from the examples and about ``sample`` of the pages at hand, both of equal weight."""
    known = pages.select("html").where("html is not null")
    size = known.count()
    share = min(1.0, sample / max(1, size))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            counted: Counter = Counter()
            for html in batch.column("html").to_pylist():
                page = Reader(None, cache).read(html)
                counted.update(tally(page, label_by_element(page)))
            rows = [(*key, n) for key, n in counted.items()]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.bool_(), pa.int64()), strict=True)],
                ["kind", "key", "label", "n"],
            )

    chosen = known.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = (
        chosen.mapInArrow(run, "kind string, key string, label boolean, n long")
        .groupBy("kind", "key", "label").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "kind", "key", "label").limit(SAMPLE_CONTEXTS).collect()
    )
    made = examples()
    mass = sum(n for (kind, _, _), n in made.items() if kind == "place")
    theirs = sum(r.n for r in found if r.kind == "place")
    scale = min(1.0, mass / max(1, theirs))
    counted = [(*key, float(n)) for key, n in sorted(made.items())]
    return fit(counted + [(r.kind, r.key, r.label, r.n * scale) for r in found])


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last index of the contiguous part with the highest sum; (0, -1) if none is positive."""
    best, region, total, begin = 0.0, (0, -1), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, region = total, (begin, i)
    return region


def main_text(html: str | None, weights: Weights, known: dict | None = None) -> str:
    if not html:
        return ""
    page = Reader(weights.place, {} if known is None else known).read(html)
    scores, odds = [], []
    default = weights.tag.get("div", -1.0)
    for event in page.events:
        if event[0] == "tag":
            scores.append(min((weights.tag[f] for f in event[1] if f in weights.tag), default=default))
            odds.append(None)
        else:
            odds.append(weights.base + event[3])
            scores.append(len(event[2].split()) / (1 + np.exp(-max(-30.0, min(30.0, odds[-1])))))
    begin, end = best_region(scores)
    if end < begin:
        return ""
    around = [e for e in page.elements if e[2] <= begin and end < e[3]]
    speaking = [e for e in around if sum(weights.place.get(f, 0.0) for f in e[1]) >= CONTAINER]
    named = next(filter(None, ([e for e in around if kind & set(e[1])] for kind in NAMED)), speaking)
    if named:
        _, _, begin, end = min(named, key=lambda e: e[3] - e[2])
        end -= 1
    blocks: dict[int, list[str]] = {}
    for i in range(begin, end + 1):
        if odds[i] is not None and odds[i] >= 0:
            blocks.setdefault(page.events[i][1], []).append(page.events[i][2])
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)  # bounded by the sample
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            texts = [main_text(h.as_py(), shared.value, known) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )


def extract_main_text(pages: DataFrame) -> DataFrame:
    return extract(pages, train(pages))
