"""Quality rules: counts over words and lines, and a content share from labelled
line sequences.

A text's lines that hold a word form a sequence.  A linear-chain conditional
random field marks each as content or boilerplate: a line has features of its
length, its marks and its place (none names a word of a language), neighbouring
labels have weights of their own, and Viterbi decoding takes the best
sequence.  The field is trained in numpy by gradient ascent of the exact
conditional likelihood (forward and backward sums) over ``LABELLED``, a small
table of hand-labelled documents; no label of the corpus is read.  A text is
kept if it passes the base rules and at least ``share`` of its word
characters lie in content lines.

Everything is a function of one text, so there is no shuffle; slices of bounded
size are scored in numpy, a longer text as a slice of its own.

Cases: null and empty texts and texts without a word have no lines, fail the
base rules and aren't kept; very long texts are read whole; rows and repeats
stay; other columns are ignored; an empty table gives an empty result.
Equal lines and equal word windows are told by 64-bit hashes within one text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import SpanHash, byte_view, mix, slices, word_spans

WINDOW = 8
# Lines of a text up to which all texts of a slice are decoded side by side.
SIDE_BY_SIDE = 400
PENALTY, RATE, TURNS = 0.05, 0.5, 600

_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_MARK = np.isin(np.arange(256), list(b"#*$%&|<>{}[]=_~^\\/+@"))
_DIVIDER = np.isin(np.arange(256), list(b"|<>"))
_DIGIT = np.isin(np.arange(256), list(b"0123456789"))
_CAPITAL = np.isin(np.arange(256), list(range(65, 91)))
_STOP = np.isin(np.arange(256), list(b".!?"))
_COMMA = np.isin(np.arange(256), list(b",;:"))
_CLOSING = np.isin(np.arange(256), list(b".!?:;,\"')"))
_WIDE = np.arange(256) >= 128
_LETTER = np.isin(np.arange(256), list(range(65, 91)) + list(range(97, 123))) | _WIDE

# Documents of labelled lines: "+" is content, "-" is boilerplate; a blank line ends a document.
LABELLED = """
- Home | About | Products | Contact
- Login  Register
+ The river has changed its course twice
+ In the spring the water rises above the lower fields, and the farmers who live there move their cattle to the hills.
+ Nobody remembers when this began. The oldest maps show two channels, one of which is now a road.
+ "We were told to leave," said the miller, "but the mill stayed."
- Share on social media
- Read more >>
- © 2019 The Valley Paper. All rights reserved.

+ A short note on bread.
+ Flour, water and salt are mixed in the evening; the dough rests until the next morning.
+ It rises slowly in the cold.
+ Then it is baked for forty minutes at a high heat, and it is left to cool on a rack before it is cut.

- Accueil | Actualités | Boutique | Nous contacter
- Accepter les cookies
+ Le vieux pont
+ Le pont fut construit par les habitants du village, qui n'avaient ni argent ni ingénieur, mais beaucoup de patience.
+ On y passe encore aujourd'hui. Les voitures doivent attendre que les piétons aient traversé.
- Partager
- Mentions légales | Politique de confidentialité | Plan du site

+ Die Bibliothek öffnet jeden Morgen um neun Uhr, auch im Winter.
+ Wer ein Buch sucht, findet es meist im zweiten Raum, denn dort stehen die Romane.
+ Am Abend werden die Lampen gelöscht und die Fenster geschlossen.

- Startseite | Impressum | Datenschutz | Kontakt
+ Ein Garten am Fluss
+ Der Garten wurde vor vielen Jahren angelegt und gehört heute der Stadt.
+ Im Sommer ist er bis in die Nacht geöffnet. Man hört dort die Frösche und den Regen.
- Newsletter abonnieren
- Alle Rechte vorbehalten.

+ La plaza estaba vacía cuando llegamos, y el reloj de la torre marcaba una hora imposible.
+ Nadie contestó. Volvimos al día siguiente con el alcalde, que tenía las llaves de la iglesia.
+ Dentro había un órgano, tres bancos y una escalera que no llevaba a ninguna parte.

- Inicio | Noticias | Deportes | Opinión
- Compartir | Imprimir | Enviar
+ El mercado abre los martes
+ Los puestos se montan antes del amanecer y se desmontan a las dos de la tarde.
- Aviso legal
- Todos los derechos reservados

- <<< 1 | 2 | 3 | 4 | 5 >>>
- #sale #new #best #hot #top
- $$$ BUY NOW $$$ LIMITED OFFER $$$
- *** click *** here *** click *** here ***
- 50% OFF %%% 50% OFF %%% 50% OFF
- >> next | << back

- word### other$$$ third%%% more&&& again*** thing### those$$$ these%%% them&&&
- alpha*** beta### gamma$$$ delta%%% epsilon&&& zeta*** eta###
- one%%% two&&& three### four$$$ five*** six%%%

- lorem | ipsum | dolor | sit | amet | tempor | magna | aliqua | veniam | nostrud
- rouge | vert | bleu | jaune | blanc | noir | gris | rose | brun
- Haus | Baum | Straße | Fluss | Berg | Wald | Wiese
- Madrid | Sevilla | Bilbao | Valencia

- Free free free free gold gold gold gold coins coins coins coins now now now now.
- Win win win win the the the the big big big big prize prize prize prize today today today today.

- item | price | stock | sku
- hammer | 12.50 | 4 | 10045
- nails | 3.20 | 800 | 10046
- saw | 18.00 | 2 | 10047
- total | 33.70 | 806 |

+ Chapter one.
+ The train was late again.
+ She waited on the platform with two suitcases and a letter that she had read so often that the paper had become soft.
+ When the train came, she did not get in.

+ Well.
+ And that was all.
+ They went home by the road along the lake, as they had done every evening of that summer, and they did not speak of it again.
+ It rained.

- Subscribe
- Username
- Password
- Forgot password?
- Sign in
+ To change the filter, open the cover on the left side and pull the handle towards you.
+ Rinse it with warm water. Do not use soap, because it closes the pores.
- Was this helpful? Yes | No

- Tags: travel, food, summer
- Posted by admin on 12/04/2016 10:22
+ We spent three days on the island. The first was windy, so we stayed in the village and ate fish.
+ On the second day we rented bicycles, which were too small, and rode to the lighthouse.
- 3 Comments
- Leave a reply

- 2015-03-01 08:00:12 GET /index.html 200
- 2015-03-01 08:00:13 GET /img/logo.png 200
- 2015-03-01 08:00:15 GET /a/b/c.css 304

- var x = {a: [1, 2, 3], b: [4, 5]};
- if (x.a[0] > 1) { return x.b[1] / 2; }
- </div></div></body></html>

+ 人们常说这条河有两个源头，但是地图上只有一个，而且没有人真正走到那里去看过。
+ 春天来的时候，水位会升高，村里的人把羊赶到山上去。

+ Река разливается каждую весну, и жители нижней улицы переезжают к родственникам.
+ Потом они возвращаются и красят заборы.

+ The committee met on Monday. It agreed that the roof should be repaired before the winter and that the costs should be shared
+ by the two parishes, as had been done after the fire.
+ The treasurer objected.
+ A second meeting was called for the end of the month, and nothing more was written down.
- Licensed under an open licence.

+ Is it true that the bell was never rung?
+ Yes; the rope was stolen in the first year.
+ And nobody bought a new one?
+ There was no money for a rope, and later there was no need of it, since everybody had a watch.

- Back to top
- Menu
- Search
- Cart (0)
- Privacy | Terms | Cookies | Help
- Follow us: F | T | I | Y
- www.example.com | info@example.com | +1 555 0100
"""


def lines_of(column: pa.Array) -> dict[str, np.ndarray]:
    """Lines that hold a word, and the words, of a column of texts."""
    buf, offsets = byte_view(column)
    raw = np.insert(buf, offsets[1:], 10)          # every text ends with a line end
    offsets = offsets + np.arange(len(offsets))
    ends = np.flatnonzero(raw == 10)
    starts = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)[:len(ends)]
    w_start, w_end, first = word_spans(raw, offsets, ~_SPACE)
    at = np.searchsorted(w_start, starts)
    upto = np.searchsorted(w_start, ends)
    held = upto > at
    doc = np.searchsorted(offsets, starts, side="right") - 1
    return {"raw": raw, "offsets": offsets, "w_start": w_start, "w_end": w_end, "first": first,
            "start": starts[held], "end": ends[held], "at": at[held], "upto": upto[held], "doc": doc[held]}


class Counts:
    """How many bytes of a kind any spans hold."""

    def __init__(self, flags: np.ndarray):
        self.sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.sums[ends] - self.sums[starts]


def equal_earlier(x: dict[str, np.ndarray], hashes: SpanHash) -> np.ndarray:
    """Whether each line equals an earlier line of its text."""
    h, n = hashes(x["start"], x["end"]), x["end"] - x["start"]
    order = np.lexsort((x["start"], n, h, x["doc"]))
    same = (h[order][1:] == h[order][:-1]) & (n[order][1:] == n[order][:-1]) & (x["doc"][order][1:] == x["doc"][order][:-1])
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    return out


def repeated_words(x: dict[str, np.ndarray], hashes: SpanHash, window: int = WINDOW) -> np.ndarray:
    """Number of each text's words that lie in a window found twice in it."""
    first = x["first"]
    words = len(x["w_start"])
    out = np.zeros(len(first) - 1, np.int64)
    if words < window:
        return out
    h = hashes(x["w_start"], x["w_end"])
    n = words - window + 1
    run = np.full(n, window, np.uint64)
    for j in range(window):
        run = mix(run + h[j:j + n])
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.flatnonzero(doc[:n] == doc[window - 1:])
    order = starts[np.lexsort((run[starts], doc[starts]))]
    same = (run[order][1:] == run[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twice = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(order) else order
    cover = np.zeros(words + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + window, -1)
    hit = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return hit[first[1:]] - hit[first[:-1]]


FEATURES = ("bias", "chars<16", "chars<40", "chars<100", "words<3", "words<6", "ends a sentence", "ends with a word", "stop inside", "comma inside",
            "marks>2%", "marks>8%", "marks>20%", "dividers in 1 of 4 words", "divider", "digits>15%", "digits>40%", "capitals>60%",
            "capital initials>60%", "short words>20%", "short words<5%", "mark in 1 of 3 words", "at or web sign", "copyright sign",
            "equal earlier line", "first line", "last line", "few letters", "echoed words>25%")


def features(x: dict[str, np.ndarray], hashes: SpanHash, repeats: np.ndarray) -> np.ndarray:
    """(lines, FEATURES) as zeros and ones."""
    raw, a, b = x["raw"], x["w_start"][x["at"]], x["w_end"][x["upto"] - 1]
    words = x["upto"] - x["at"]
    count = lambda table: Counts(table[raw])(a, b)
    chars = (b - a) - Counts((raw & 0xC0) == 0x80)(a, b)
    letters, marks, capitals = count(_LETTER), count(_MARK), count(_CAPITAL)
    by_word = lambda flags: (lambda s: s[x["upto"]] - s[x["at"]])(np.concatenate([[0], np.cumsum(flags)]))
    marked = Counts(_MARK[raw])(x["w_start"], x["w_end"]) > 0
    size = x["w_end"] - x["w_start"]
    word = hashes(x["w_start"], x["w_end"])
    echo = np.concatenate([[False], word[1:] == word[:-1]]) if len(word) else np.zeros(0, bool)
    plain = _LETTER[raw[x["w_end"] - 1]] & _LETTER[raw[x["w_start"]]]
    last, before = raw[b - 1], raw[np.maximum(b - 2, a)]
    wide_stop = (last == 0x82) & (before == 0x80)          # the last bytes of the ideographic full stop
    two = np.concatenate([raw[:-1].astype(np.int64) << 8 | raw[1:], [0]]) if len(raw) else np.zeros(0, np.int64)
    edge = np.concatenate([[True], x["doc"][1:] != x["doc"][:-1], [True]]) if len(words) else np.zeros(1, bool)
    share = lambda part, whole, limit: part > limit * whole
    columns = [np.ones(len(words), bool), chars < 16, chars < 40, chars < 100, words < 3, words < 6, _STOP[last] | wide_stop,
               ~_CLOSING[last] & ~_MARK[last], count(_STOP) > 1, count(_COMMA) > 0, share(marks, chars, 0.02), share(marks, chars, 0.08),
               share(marks, chars, 0.2), share(count(_DIVIDER), words, 0.25), count(_DIVIDER) > 0, share(count(_DIGIT), chars, 0.15),
               share(count(_DIGIT), chars, 0.4), share(capitals, letters, 0.6), share(by_word(_CAPITAL[raw[x["w_start"]]]), words, 0.6),
               share(by_word((size <= 3) & plain), words, 0.2), ~share(by_word((size <= 3) & plain), words, 0.05), share(by_word(marked), words, 0.33),
               Counts((raw == 64) | (two == (119 << 8 | 119)))(a, b) > 0, Counts(two == (0xC2 << 8 | 0xA9))(a, b) > 0,
               repeats, edge[:-1], edge[1:], ~share(letters, b - a, 0.4), share(by_word(echo), words, 0.25)]
    return np.stack(columns, axis=1).astype(np.float64)


def labelled() -> tuple[pa.Array, list[np.ndarray]]:
    """(texts, states of their lines) of the table; state 0 is content."""
    docs = [[line for line in d.split("\n") if line] for d in LABELLED.strip().split("\n\n")]
    return pa.array(["\n".join(line[2:] for line in d) for d in docs]), [np.array([int(line[0] == "-") for line in d]) for d in docs]


@cache
def train(penalty: float = PENALTY, rate: float = RATE, turns: int = TURNS) -> tuple[np.ndarray, np.ndarray]:
    """(weights of the features by state, weights of neighbouring states) that
    maximise the penalised likelihood of the table."""
    texts, states = labelled()
    x = lines_of(texts)
    hashes = SpanHash(x["raw"])
    values = features(x, hashes, equal_earlier(x, hashes))
    length = np.array([len(s) for s in states])
    d, t = len(states), int(length.max())
    grid, y, there = np.zeros((d, t, values.shape[1])), np.zeros((d, t), int), np.arange(t) < length[:, None]
    grid[there], y[there] = values, np.concatenate(states)
    right = np.eye(2)[y] * there[:, :, None]
    pairs = there[:, 1:]
    seen = np.einsum("dta,dtb->ab", right[:, :-1] * pairs[:, :, None], right[:, 1:])
    w, link = np.zeros((2, values.shape[1])), np.zeros((2, 2))
    for turn in range(turns):
        emit = grid @ w.T
        ahead, back = np.zeros((d, t, 2)), np.zeros((d, t, 2))
        ahead[:, 0] = emit[:, 0]
        for i in range(1, t):
            step = np.logaddexp.reduce(ahead[:, i - 1, :, None] + link, axis=1) + emit[:, i]
            ahead[:, i] = np.where(there[:, i, None], step, ahead[:, i - 1])
        for i in range(t - 2, -1, -1):
            step = np.logaddexp.reduce(link + (emit[:, i + 1] + back[:, i + 1])[:, None, :], axis=2)
            back[:, i] = np.where(there[:, i + 1, None], step, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        alone = np.exp(ahead + back - total[:, None, None]) * there[:, :, None]
        both = np.exp(ahead[:, :-1, :, None] + link + (emit[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None])
        both *= pairs[:, :, None, None]
        n = length.sum()
        # A falling rate settles the weights.
        size = rate * (1 - turn / turns) + 0.01
        w += size * (np.einsum("dts,dtf->sf", right - alone, grid) / n * 4 - penalty * w / 10)
        link += size * ((seen - both.sum((0, 1))) / n * 4 - penalty * link / 10)
    return w, link


def decode_one(emit: list[list[float]], link: list[list[float]]) -> list[int]:
    """The best states of one sequence; of equal ones state 0."""
    (cc, cb), (bc, bb) = link
    c, b = emit[0]
    came = []
    for ec, eb in emit[1:]:
        to_c, to_b = int(b + bc > c + cc), int(b + bb > c + cb)
        came.append((to_c, to_b))
        c, b = ec + (b + bc if to_c else c + cc), eb + (b + bb if to_b else c + cb)
    state = int(b > c)
    out = [state]
    for pair in reversed(came):
        state = pair[state]
        out.append(state)
    return out[::-1]


def decode(emit: np.ndarray, doc: np.ndarray, link: np.ndarray, side_by_side: int = SIDE_BY_SIDE) -> np.ndarray:
    """The best state of each line (Viterbi); lines of one ``doc`` are a sequence."""
    out = np.zeros(len(emit), np.int64)
    if not len(emit):
        return out
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    length = np.diff(np.concatenate([begin, [len(doc)]]))
    for i in np.flatnonzero(length > side_by_side):
        out[begin[i]:begin[i] + length[i]] = decode_one(emit[begin[i]:begin[i] + length[i]].tolist(), link.tolist())
    short = np.flatnonzero(length <= side_by_side)
    order = short[np.argsort(-length[short], kind="stable")]
    begin, length = begin[order], length[order]
    longer = lambda t: int(np.searchsorted(-length, -t, side="left"))  # noqa: E731 - texts of more than t lines; they come first
    best, came = emit[begin], np.zeros((len(emit), 2), np.int8)
    longest = int(length.max(initial=0))
    for t in range(1, longest):
        n = longer(t)
        step = best[:n, :, None] + link
        from_b = step[:, 1] > step[:, 0]
        came[begin[:n] + t] = from_b
        best[:n] = np.where(from_b, step[:, 1], step[:, 0]) + emit[begin[:n] + t]
    state = (best[:, 1] > best[:, 0]).astype(np.int64)
    for t in range(longest - 1, -1, -1):
        n = longer(t)
        at = begin[:n] + t
        out[at] = state[:n]
        if t:
            state[:n] = came[at, state[:n]]
    return out


def judge(column: pa.Array, model: tuple[np.ndarray, np.ndarray]) -> dict[str, np.ndarray]:
    """Counts and the content share of each text."""
    x = lines_of(column)
    raw, offsets, first = x["raw"], x["offsets"], x["first"]
    hashes = SpanHash(raw)
    n = len(offsets) - 1
    chars = (x["w_end"] - x["w_start"]) - Counts((raw & 0xC0) == 0x80)(x["w_start"], x["w_end"])
    upto = np.concatenate([[0], np.cumsum(chars)])
    repeats = equal_earlier(x, hashes)
    states = decode(features(x, hashes, repeats) @ model[0].T, x["doc"], model[1])
    content = np.bincount(x["doc"], weights=(upto[x["upto"]] - upto[x["at"]]) * (states == 0), minlength=n)
    total = upto[first[1:]] - upto[first[:-1]]
    return {"n_words": np.diff(first).astype(np.int64), "word_chars": total, "n_symbols": Counts(_SYMBOL[raw])(offsets[:-1], offsets[1:]),
            "n_dup_lines": np.bincount(x["doc"][repeats], minlength=n).astype(np.int64), "n_repeat_words": repeated_words(x, hashes),
            "n_lines": np.bincount(x["doc"], minlength=n).astype(np.int64),
            "content_share": np.where(total > 0, content / np.maximum(total, 1), 0.0)}


OUT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, content_share double"


def rules(docs: DataFrame, share: float = 0.5, least_words: int = 20, most_repeats: int = 30) -> DataFrame:
    """doc_id, the counts, base_failed, content_share and kept of every row."""
    model = train()     # a few dozen numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            got = judge(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, got.values())], names=["doc_id", *got])

    judged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")) \
        .mapInArrow(run, f"doc_id long, {OUT}")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("content_share") >= share))
