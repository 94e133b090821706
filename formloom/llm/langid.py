"""Language identification by hyperdimensional profiles.

Each letter (by code point, lower-cased) and the gap between runs of letters has a random vector of D signs. A letter
n-gram's vector binds its letters' vectors by multiplication, each rolled by one place more the earlier it stands. A
document's vector bundles (adds) those of its n-grams; a language's prototype bundles its documents'. A document gets
the language whose prototype has the largest cosine with it, ties to the first by code point; the score is that
cosine, 0 at least.

Bundling is linear: to learn, each task counts its documents' n-grams by language, counts are summed by language and
n-gram, and vectors are made only of the sums. All sums are of whole numbers, so results don't depend on the order of rows.

A null text, or one without letters, is `und` with score 0, as is all text where nothing was learned. Languages with a
null name are not learned. Prototypes of all languages are sent to all tasks: D numbers a language, of LANGUAGES languages at most; more are an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import Scratch

D, SEED, LANGUAGES = 1024, 20_011, 4096
#: Letters with a place in a worker's table of n-grams, and n-grams with a vector there (4 KB each).
LETTERS, GRAMS = 128, 25_000
#: Code points that are handled at once: memory does not grow with a text.
SLICE = 1 << 20


class Space:
    """Vectors of letters and trigrams; a worker makes each once."""

    def __init__(self):
        import numpy as np

        self.np, self.signs = np, {}
        self.letter = np.zeros(0x110000, bool)
        self.letter[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        self.clear()

    def clear(self) -> None:
        np = self.np
        self.place = {}
        self.rows = np.full(LETTERS**3, -1, np.int32)
        self.made, self.used = np.empty((0, D), np.float32), 0

    def sign(self, code: int):
        np = self.np
        if code not in self.signs:
            self.signs[code] = np.random.RandomState((SEED * 1_000_003 + code) % (1 << 32)).choice(np.float32([-1, 1]), D)
        return self.signs[code]

    def grams(self, text: str):
        """(trigrams, counts). A trigram is a number of three times 21 bits."""
        np, found = self.np, []
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        tail = np.zeros(1, np.uint32)
        for at in range(0, len(points), SLICE):
            own = points[at : at + SLICE]
            own = np.r_[tail, np.where(self.letter[own], own, 0), np.zeros(int(at + SLICE >= len(points)), np.uint32)]
            own = own[np.r_[True, (own[1:] != 0) | (own[:-1] != 0)]].astype(np.int64)
            tail = own[-2:].astype(np.uint32)
            if len(own) > 2:
                found.append((own[:-2] << 42) | (own[1:-1] << 21) | own[2:])
        return np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64), np.empty(0, np.int64))

    def vectors(self, grams):
        np, mask = self.np, (1 << 21) - 1
        a, b, c = grams >> 42, grams >> 21 & mask, grams & mask
        codes, inv = np.unique(np.concatenate([a, b, c]), return_inverse=True)
        letters = np.stack([self.sign(int(x)) for x in codes])
        a, b, c = inv.reshape(3, -1)
        return np.roll(letters, 2, 1)[a] * np.roll(letters, 1, 1)[b] * letters[c]

    def bundle(self, grams, counts):
        """The sum of the trigrams' vectors times their counts."""
        np, mask = self.np, (1 << 21) - 1
        parts = [grams >> 42, grams >> 21 & mask, grams & mask]
        codes = np.unique(np.concatenate(parts))
        for x in codes[[int(x) not in self.place for x in codes]] if len(self.place) < LETTERS else ():
            self.place.setdefault(int(x), len(self.place))
        at = [self.place.get(int(x), LETTERS) for x in codes]
        if max(at, default=0) >= LETTERS:  # letters without a place: nothing is remembered
            total = np.zeros(D)
            for lo in range(0, len(grams), 4096):
                total += counts[lo : lo + 4096].astype(np.float32) @ self.vectors(grams[lo : lo + 4096])
            return total
        at = np.array(at)
        a, b, c = (at[np.searchsorted(codes, p)] for p in parts)
        key = (a * LETTERS + b) * LETTERS + c
        rows = self.rows[key]
        if (new := rows < 0).any():
            if self.used + new.sum() > GRAMS and self.used:
                self.clear()
                return self.bundle(grams, counts)
            need = self.used + int(new.sum())
            if need > len(self.made):
                grown = np.empty((max(need, min(GRAMS, 2 * len(self.made) + 1024)), D), np.float32)
                grown[: self.used] = self.made[: self.used]
                self.made = grown
            self.made[self.used : need] = self.vectors(grams[new])
            self.rows[key[new]] = np.arange(self.used, need)
            self.used = need
            rows = self.rows[key]
        return counts.astype(np.float32) @ self.made[rows]


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, list[float]]:
    """Prototypes of all languages in `df`."""

    def count(batches):
        import numpy as np
        import pyarrow as pa

        space, held = Space(), {}

        def out(lang):
            grams, counts = merged(held.pop(lang))
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])

        def merged(own):
            grams, inv = np.unique(np.concatenate([g for g, _ in own]), return_inverse=True)
            return grams, np.bincount(inv, np.concatenate([n for _, n in own])).astype(np.int64)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = held.setdefault(lang, [])
                own.append(space.grams(text))
                if len(own) > 256:
                    held[lang] = [merged(own)]
            while len(held) > 64:  # many languages: the first ones go on
                yield out(next(iter(held)))
        for lang in list(held):
            yield out(lang)

    def bundle(batches):
        import numpy as np
        import pyarrow as pa

        space, sums = Space(), {}
        for b in batches:
            lang, gram, n = np.array(b.column(0).to_pylist(), object), b.column(1).to_numpy(), b.column(2).to_numpy()
            for at in range(0, len(gram), 2048):
                s = slice(at, at + 2048)
                vectors = space.vectors(gram[s])
                for x in dict.fromkeys(lang[s]):
                    own = lang[s] == x
                    sums[x] = sums.get(x, 0) + n[s][own].astype(np.float64) @ vectors[own]
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(sums), pa.string()), "v": pa.array([x.tolist() for x in sums.values()], pa.list_(pa.float64()))})

    texts = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    counts = Scratch(df.sparkSession, "langid").save(texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "counts")
    many = counts.select("lang").distinct().count()
    if many > LANGUAGES:
        raise ValueError(f"{many} languages, and {LANGUAGES} at most can be held")
    parts = counts.mapInArrow(bundle, "lang string, v array<double>")
    summed = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    vectors = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).collect()
    return {r.lang: [p.x for p in r.v] for r in sorted(vectors, key=lambda r: r.lang)}


def predict(df: DataFrame, prototypes: dict[str, list[float]], text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep` of `df` with lang_pred and score."""
    sent = df.sparkSession.sparkContext.broadcast(prototypes)
    names = [*keep, "lang_pred", "score"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        langs = sorted(sent.value)
        profile = np.array([sent.value[x] for x in langs], np.float64).reshape(len(langs), D)
        profile /= np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-300)
        space = Space()
        for b in batches:
            pred, score = [], []
            for text in b.column(len(keep)).to_pylist():
                grams, counts = space.grams(text or "")
                if not langs or not len(grams):
                    pred.append("und")
                    score.append(0.0)
                    continue
                v = space.bundle(grams, counts).astype(np.float64)
                cos = profile @ v / max(np.linalg.norm(v), 1e-300)
                best = int(np.argmax(cos))
                pred.append(langs[best])
                score.append(min(1.0, max(0.0, float(cos[best]))))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(pred, pa.string()), pa.array(score, pa.float64())], names)

    rows = df.select(*keep, F.col(text_col).cast("string").alias("_text"))
    schema = rows.drop("_text").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    return rows.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves 1 when divided by 3. A null id counts as an empty text: it is learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1
