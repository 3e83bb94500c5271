"""HTML main-text extraction by a recurrent block labeller (operator 5).

A page becomes the sequence of its leaf blocks: runs of text between the edges of
block elements.  Every block has its tag path (names, class, id and role words
of the open elements), its decoded text and a few figures.  Path words and
text words are hashed into two vectors; a bidirectional LSTM in numpy reads the
sequence in both directions and labels each block with the whole document as
context.  Blocks labelled as main text are joined in page order.

Training is on a bounded sample: ``sample_pages`` pages (chosen by the
hashes of the URL and id), labelled by their semantic elements (inside ``article`` or
``main`` and not inside a navigation, form or side element).  Pages without
such elements teach nothing.  From the sampled texts, pages with other usual
structures (side bars, notices, adverts, comments, class names in place of
semantic elements) are put together too, so that the labeller does not hang on
one template.  The model is trained on the driver and broadcast; its size is
fixed by its parameters.

Defined results: a null or empty page has the text ''; malformed HTML is read
as far as it goes (an unclosed comment or script runs to the end); repeated
rows give one row each; without any labelled page the model learns from the
composed ones only, or, without pages, an empty result is given.
"""

from __future__ import annotations

import html as _html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav ol optgroup option p "
    "pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template svg math object canvas".split())
#: An element of the first kind ends an open one of the second, unless a tag of the third lies between.
_IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
_P_SCOPE = frozenset("article aside body div section main td th li table blockquote form header footer nav button".split())


class Path:
    """The words of an element and of those around it, linked to the parent: a page's paths take memory in proportion to its tags."""

    __slots__ = ("parent", "words", "bits", "known")

    def __init__(self, parent: Path | None, words: tuple[str, ...]):
        self.parent, self.words = parent, words
        #: hashed words, and words with a meaning of their own, of the whole path
        self.bits, self.known = (parent.bits, parent.known) if parent is not None else (0, frozenset())
        for w in words:
            self.bits |= 1 << (_hashed(w) % PATH_DIM)
            if w in _KNOWN and w not in self.known:
                self.known = self.known | {w}

    def __iter__(self):
        chain, at = [], self
        while at is not None:
            chain.append(at.words)
            at = at.parent
        return (w for words in reversed(chain) for w in words)


def _named(path, names: frozenset) -> bool:
    """Whether one of ``names`` (all of them in ``_KNOWN``) is on the path."""
    return bool((path.known if isinstance(path, Path) else set(path)) & names)


def leaf_blocks(page: str) -> list[tuple[Path, str, int]]:
    """(path, text, characters inside links) of each leaf block with any text."""
    out: list[tuple[Path, str, int]] = []
    tags: list[str] = []
    open_at: dict[str, list[int]] = {}  # where the open elements of a name stand in ``tags``
    paths: list[Path] = [Path(None, ())]
    parts: list[str] = []
    linked = depth = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append((paths[-1], text, linked))
            parts.clear()
        linked = 0

    def pop_to(k: int) -> None:
        nonlocal depth
        for name in tags[k:]:
            depth -= name == "a"
            open_at[name].pop()
        del tags[k:], paths[k + 1:]

    def last(names) -> int:
        return max((open_at[n][-1] for n in names if open_at.get(n)), default=-1)

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        text = page[at:mark] if mark >= 0 else page[at:]
        if text:
            parts.append(_html.unescape(text))  # a reference never spans a tag
            linked += len(text) if depth > 0 else 0
        if mark < 0:
            break
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        m = _TAG.match(page, mark)
        if m is None:
            if mark + 1 < size and (page[mark + 1].isalpha() or page[mark + 1] == "/"):
                end = page.find(">", mark)  # an odd or cut-off tag is no text
                at = size if end < 0 else end + 1
            else:
                parts.append("<")
                at = mark + 1
            continue
        at = m.end()
        closing, name, rest = m[1], m[2].lower(), m[3]
        if closing:
            if name in BLOCK_TAGS:
                close()
            if open_at.get(name):
                pop_to(open_at[name][-1])
            continue
        if name in RAW_TAGS:
            if not rest.endswith("/"):
                end = re.compile(f"</{re.escape(name)}[^>]*>?", re.I).search(page, at)
                at = size if end is None else end.end()
            continue
        if name == "br":
            parts.append(" ")
        if name in BLOCK_TAGS:
            close()
            ends, scope = _IMPLIED.get(name, (frozenset(), frozenset()))
            ended = last((*ends, "p"))
            if ended >= 0 and ended >= last(scope if ends else _P_SCOPE):
                pop_to(ended)
        if name in VOID_TAGS or rest.endswith("/"):
            continue
        words = [name]
        for a in _ATTRIBUTE.findall(rest):
            words += _NAME.findall("".join(a).lower())
        open_at.setdefault(name, []).append(len(tags))
        tags.append(name)
        depth += name == "a"
        paths.append(Path(paths[-1], tuple(words)))
    close()
    return out


PATH_DIM, WORD_DIM = 128, 32
DIM = PATH_DIM + WORD_DIM + 6
_HASHED: dict[str, int] = {}


def _hashed(word: str) -> int:
    got = _HASHED.get(word)
    if got is None:
        if len(_HASHED) > 100_000:
            _HASHED.clear()
        got = _HASHED[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return got


def features(blocks: list[tuple]) -> np.ndarray:
    """One vector a block: hashed path words, hashed text words, figures."""
    x = np.zeros((len(blocks), DIM), dtype=np.float32)
    for k, (path, text, linked) in enumerate(blocks):
        bits = path.bits if isinstance(path, Path) else Path(None, path).bits
        x[k, :PATH_DIM] = np.unpackbits(np.frombuffer(bits.to_bytes(PATH_DIM // 8, "little"), dtype=np.uint8), bitorder="little")
        words = text.split()
        codes = np.fromiter((_hashed(w) % WORD_DIM for w in words), dtype=np.int64, count=len(words))
        x[k, PATH_DIM:PATH_DIM + WORD_DIM] = np.bincount(codes, minlength=WORD_DIM) / max(1, len(words))
        x[k, -6:] = (np.log1p(len(words)) / 5, np.log1p(len(text)) / 8, linked / max(1, len(text)),
                     sum(text.count(c) for c in ".,;!?") / max(1, len(words)), k / max(1, len(blocks)), 1)
    return x


class Labeller:
    """Bidirectional LSTM with a logistic output for each step."""

    def __init__(self, hidden: int = 16, seed: int = 7, dim: int = DIM):
        rng = np.random.default_rng(seed)
        self.h = hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":  # forwards, backwards
            self.p[f"x{d}"] = rng.normal(0, 0.1, (dim, 4 * hidden)).astype(np.float32)
            self.p[f"h{d}"] = rng.normal(0, 0.2, (hidden, 4 * hidden)).astype(np.float32)
            self.p[f"b{d}"] = np.repeat(np.array([0, 1, 0, 0], dtype=np.float32), hidden)  # open forget gates
        self.p["out"] = rng.normal(0, 0.2, (2 * hidden, 1)).astype(np.float32)
        self.p["bias"] = np.zeros(1, dtype=np.float32)

    @staticmethod
    def _sigmoid(z: np.ndarray) -> np.ndarray:
        return 0.5 * (1 + np.tanh(0.5 * z))

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        steps, batch, _ = x.shape
        h = c = np.zeros((batch, self.h), dtype=np.float32)
        z = x.reshape(steps * batch, -1) @ self.p[f"x{d}"] + self.p[f"b{d}"]
        z = z.reshape(steps, batch, -1)
        out = np.zeros((steps, batch, self.h), dtype=np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = z[t] + h @ self.p[f"h{d}"]
            gates, g = self._sigmoid(a[:, :3 * self.h]), np.tanh(a[:, 3 * self.h:])
            i, f, o = np.split(gates, 3, axis=1)
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc, m))
            h, c = m * (o * tc) + (1 - m) * h, m * c_new + (1 - m) * c
            out[t] = h
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Probabilities (steps, batch) of inputs (steps, batch, features)."""
        traces = {d: [] for d in "fb"} if keep is not None else {"f": None, "b": None}
        both = np.concatenate([self._run(x, mask, d, traces[d]) for d in "fb"], axis=2)
        if keep is not None:
            keep.update(both=both, traces=traces)
        return self._sigmoid(both @ self.p["out"] + self.p["bias"])[..., 0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy over the masked steps."""
        keep: dict = {}
        dz = ((self.forward(x, mask, keep) - y) * mask / mask.sum())[..., None]
        grad = {"out": np.einsum("tbh,tbo->ho", keep["both"], dz), "bias": dz.sum(axis=(0, 1))}
        d_both = dz @ self.p["out"].T
        for d, part in (("f", d_both[..., :self.h]), ("b", d_both[..., self.h:])):
            da = np.zeros((*x.shape[:2], 4 * self.h), dtype=np.float32)
            gh, dh, dc = np.zeros_like(self.p[f"h{d}"]), 0.0, 0.0
            for t, h, c, i, f, o, g, tc, m in reversed(keep["traces"][d]):
                dh = dh + part[t]
                own = dh * m
                dc_own = dc * m + own * o * (1 - tc * tc)
                da[t] = np.concatenate((dc_own * g * i * (1 - i), dc_own * c * f * (1 - f), own * tc * o * (1 - o),
                                        dc_own * i * (1 - g * g)), axis=1)
                gh += h.T @ da[t]
                dh = da[t] @ self.p[f"h{d}"].T + dh * (1 - m)
                dc = dc_own * f + dc * (1 - m)
            flat = da.reshape(-1, 4 * self.h)
            grad[f"h{d}"], grad[f"b{d}"] = gh, flat.sum(axis=0)
            grad[f"x{d}"] = x.reshape(-1, x.shape[2]).T @ flat
        return grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 6, batch: int = 16, rate: float = 0.02,
            seed: int = 11) -> Labeller:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = np.argsort([len(x) + rng.random() for x, _ in pages])
            groups = [order[k:k + batch] for k in range(0, len(order), batch)]
            for g in rng.permutation(len(groups)):
                x, mask, y = padded([pages[k][0] for k in groups[g]], [pages[k][1] for k in groups[g]])
                step += 1
                for k, v in self.gradients(x, mask, y).items():
                    v = np.clip(v, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    self.p[k] = (self.p[k] - rate * (first[k] / (1 - 0.9 ** step))
                                 / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray], cells: int = 20_000) -> list[np.ndarray]:
        """True for main text, by block; pages of like length are run together."""
        out = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            longest = len(pages[order[-1]])
            take = max(1, cells // longest)
            group, order = order[-take:], order[:-take]
            x, mask, _ = padded([pages[k] for k in group])
            p = self.forward(x, mask)
            for b, k in enumerate(group):
                out[k] = p[:len(pages[k]), b] > 0.5
        return out


def padded(xs: list[np.ndarray], ys: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(x) for x in xs)
    x = np.zeros((steps, len(xs), xs[0].shape[1]), dtype=np.float32)
    mask, y = np.zeros((steps, len(xs)), dtype=np.float32), np.zeros((steps, len(xs)), dtype=np.float32)
    for k, own in enumerate(xs):
        x[:len(own), k], mask[:len(own), k] = own, 1
        if ys is not None:
            y[:len(own), k] = ys[k]
    return x, mask, y


MAIN_TAGS = frozenset(("article", "main"))
SIDE_TAGS = frozenset(("nav", "aside", "footer", "header", "form", "head", "button", "label", "select", "dialog"))
SIDE_WORDS = frozenset(("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "sidebar", "menu", "cookie",
                        "consent", "notice", "comments", "comment", "related", "share", "social", "newsletter", "breadcrumb"))
_KNOWN = MAIN_TAGS | SIDE_TAGS | SIDE_WORDS


def semantic_labels(blocks: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray | None:
    """Labels from semantic elements; None if the page has none for its main text."""
    if not any(_named(path, MAIN_TAGS) for path, _, _ in blocks):
        return None
    return np.array([_named(path, MAIN_TAGS) and not _named(path, SIDE_TAGS | SIDE_WORDS) for path, _, _ in blocks],
                    dtype=np.float32)


_MAIN_PATHS = ("article", "main", "main article", "div article", "div content", "div main content", "div post", "div entry content",
               "div post body", "section article body", "div story", "div text", "div", "section")
_MAIN_LEAVES = ("p", "p", "p", "p", "h1", "h2", "blockquote", "ul li", "pre", "p b", "div p")
_SIDE_PATHS = ("head title", "nav ul li a", "div menu ul li a", "div breadcrumb a", "header h1", "header p", "div header p", "footer p",
               "footer", "div footer p", "aside p", "aside h3", "div sidebar p", "div sidebar ul li a", "div ad", "div ads p", "div advert p",
               "div sponsored p", "div promo p", "div banner p", "div cookie notice p", "div notice p", "div consent p", "div alert p",
               "form label", "form p", "form button", "div newsletter form p", "div subscribe p", "div share a", "div social ul li a",
               "div related ul li a", "section comments p", "div comments div comment p", "ol comments li p", "div comment p", "div reply p")
#: What a side block inside the main element looks like.
_INNER_PATHS = ("aside p", "div ad", "div advert p", "div related ul li a", "form p", "div share a", "div newsletter p", "nav ul li a",
                "div notice p", "section comments p", "div comments div comment p", "footer p", "header p")


def composed_page(texts: list[str], rng: np.random.Generator) -> tuple[list, np.ndarray]:
    """A page put together from sampled texts, with its labels."""
    def text(short: bool) -> str:
        words = texts[rng.integers(len(texts))].split()
        at = int(rng.integers(max(1, len(words))))
        return " ".join(words[at:at + int(rng.integers(1, 6 if short else 60))]) or "x"

    def block(path: str, short: bool):
        t = text(short)
        return tuple(path.split()), t, len(t) if path.split()[-1] == "a" else 0

    main = _MAIN_PATHS[rng.integers(len(_MAIN_PATHS))]
    plain = main in ("div", "section")
    blocks, labels = [], []

    def side(n: int) -> None:
        for _ in range(n):
            path = _SIDE_PATHS[rng.integers(len(_SIDE_PATHS))]
            for _ in range(int(rng.integers(1, 6)) if path.endswith(" a") else int(rng.integers(1, 4))):
                blocks.append(block(("html " if path.startswith("head ") else "html body ") + path, plain or rng.random() < 0.6))
                labels.append(0)

    side(int(rng.integers(1, 5)))
    for _ in range(int(rng.integers(1, 9))):
        if rng.random() < 0.12:
            blocks.append(block(f"html body {main} {_INNER_PATHS[rng.integers(len(_INNER_PATHS))]}", rng.random() < 0.6))
            labels.append(0)
        else:
            blocks.append(block(f"html body {main} {_MAIN_LEAVES[rng.integers(len(_MAIN_LEAVES))]}", not plain and rng.random() < 0.3))
            labels.append(1)
    side(int(rng.integers(0, 4)))
    return blocks, np.array(labels, dtype=np.float32)


def train(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sample_pages: int = 200,
          composed: int = 600, max_blocks: int = 200, seed: int = 7) -> Labeller:
    """Fit the labeller on at most ``sample_pages`` pages and ``composed`` pages made of their texts.

    Training sequences are windows of at most ``max_blocks`` blocks.
    """
    rows = pages.select(F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.col(f"`{url_col}`").cast("string")).alias("h"),
                        F.col(f"`{html_col}`").cast("string").alias("html")).where("html is not null")
    # about four times the sample by hash first: what tasks send to the driver does not grow with their number
    n = rows.count()
    share = min(1.0, (4 * sample_pages + 50) / max(1, n))
    some = rows.where(F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30)) < share)
    sample = some.orderBy("h", F.sha2("html", 256)).limit(sample_pages).collect()
    rng = np.random.default_rng(seed)
    data, texts = [], []
    for row in sample:
        blocks = leaf_blocks(row["html"])
        texts += [t[:2000] for _, t, _ in blocks[:max_blocks]]
        labels = semantic_labels(blocks)
        if labels is not None:
            at = int(rng.integers(max(1, len(blocks) - max_blocks + 1)))
            data.append((features(blocks)[at:at + max_blocks], labels[at:at + max_blocks]))
    for _ in range(composed if texts else 0):
        blocks, labels = composed_page(texts, rng)
        data.append((features(blocks), labels))
    model = Labeller(seed=seed)
    return model.fit(data) if data else model


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)  # fixed size: its parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                blocks = [leaf_blocks(t.as_py()) for t in part.column(2)]
                labels = shared.value.label([features(x) for x in blocks])
                text = ["\n\n".join(t for (_, t, _), main in zip(x, y) if main) for x, y in zip(blocks, labels)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()),
                                                  pa.array([len(t) for t in text], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
