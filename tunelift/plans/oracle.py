"""SQL text of the flows for the DuckDB oracle (test-only; Spark never runs it).

Named SQL fragments are assembled into one ``WITH`` query per key; a fragment is
included when its name appears in the text that needs it.
"""

from __future__ import annotations

import re

from ..functions.columns import CONFIDENCE_CODES
from .bindings import ROLE_SQL


def clean(x: str) -> str:
    return f"lower(regexp_replace({x}, '[^A-Za-z0-9]', '', 'g'))"


def num0(x: str) -> str:
    return f"coalesce(TRY_CAST({x} AS DOUBLE), 0.0)"


def ordinal(x: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in CONFIDENCE_CODES.items())
    return f"CAST(coalesce(CASE {x} {arms} END, -1) AS INTEGER)"


def fround(x: str, d: int) -> str:
    """Same rounding as ``functions.columns.fixed_round``."""
    for k in (d + 3, d):
        s = float(10 ** k)
        x = f"(round_even({x} * {s}::DOUBLE, 0) / {s}::DOUBLE)"
    return x


def split_bucket(x: str) -> str:
    return f"(('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 8))::BIGINT % 100)"


SONG_NUMERIC = ["artist_hotttnesss", "artist_familiarity", "loudness", "tempo",
                "duration", "song_hotttnesss"]
WIDE = ["td_confidence", "artist_hotttnesss", "artist_familiarity", "loudness", "tempo",
        "duration", "song_hotttnesss", "year", "play_count", "song_count", "weight_dot_freq",
        "similar_artist_count", "likes", "td_meanPrice", "genre_match_count", "popularity",
        "td_downloads"]


def _term_rank(suffix: str, hot: str, songs: str, k: int) -> dict[str, str]:
    return {
        f"term_hot_{suffix}": f"""
            SELECT t.artist_term, CAST(sum(CAST({hot} AS DECIMAL(38, 15))) AS DOUBLE)
                                  / nullif(count({hot}), 0) AS artist_hotness
            FROM artist_terms t JOIN {songs} s ON t.artist_id = s.artist_id
            GROUP BY t.artist_term""",
        f"top_{suffix}": f"""
            SELECT artist_term, artist_hotness FROM term_hot_{suffix}
            ORDER BY artist_hotness DESC NULLS LAST, artist_term LIMIT {k}""",
        f"genre_{suffix}": f"""
            SELECT t.artist_id,
                   CAST(count(DISTINCT CASE WHEN tp.artist_term IS NOT NULL
                                            THEN t.artist_term END) AS INTEGER) AS genre_match_count
            FROM (SELECT DISTINCT artist_id, artist_term FROM artist_terms) t
                 LEFT JOIN top_{suffix} tp ON t.artist_term = tp.artist_term
            GROUP BY t.artist_id""",
    }


FRAGMENTS: dict[str, str] = dict(ROLE_SQL)
FRAGMENTS.update({
    "songs_a": f"""
        SELECT {clean('artist_name')} AS artist_name, {clean('title')} AS title,
               {num0('song_hotttnesss')} AS song_hotness,
               {num0('artist_hotttnesss')} AS artist_hotness,
               {num0('tempo')} AS tempo, artist_id, song_id, track_id
        FROM song_info""",
    "songs_b": f"""
        SELECT song_id, track_id, artist_id, {clean('lower(artist_name)')} AS artist_name,
               {clean('lower(title)')} AS title,
               {', '.join(f"{num0(c)} AS {c}" for c in SONG_NUMERIC)}, year
        FROM song_info""",
    "sim_count": """
        SELECT artist_id, count(similar_artist) AS similar_artist_count
        FROM similar_artists GROUP BY artist_id""",
    "song_count_b": """
        SELECT artist_id, count(song_id) AS song_count FROM songs_b GROUP BY artist_id""",
    "wf_b": """
        SELECT artist_id,
               sum(TRY_CAST(weight AS DOUBLE) * TRY_CAST(freq AS DOUBLE)) AS weight_dot_freq
        FROM term_scores
        WHERE TRY_CAST(weight AS DOUBLE) IS NOT NULL AND TRY_CAST(freq AS DOUBLE) IS NOT NULL
        GROUP BY artist_id""",
    "raw_hot": """
        SELECT artist_id, TRY_CAST(artist_hotttnesss AS DOUBLE) AS raw_hotness FROM song_info""",
    "dl_a": f"""
        SELECT {clean('artist')} AS td_artist, {clean('title')} AS td_title,
               TRY_CAST(mean_price AS DOUBLE) AS td_meanPrice,
               TRY_CAST(downloads AS DOUBLE) AS td_downloads,
               {ordinal('confidence')} AS td_confidence
        FROM downloads WHERE TRY_CAST(mean_price AS DOUBLE) IS NOT NULL""",
    "dl_b": f"""
        SELECT {clean('artist')} AS td_artist, {clean('title')} AS td_title,
               TRY_CAST(mean_price AS DOUBLE) AS td_meanPrice,
               TRY_CAST(downloads AS DOUBLE) AS td_downloads,
               {ordinal('confidence')} AS td_confidence
        FROM downloads""",
    "serving_songs": """
        SELECT s.*, coalesce(p.play_count, 0) AS play_count,
               coalesce(sc.similar_artist_count, 0) AS similar_artist_count,
               g.genre_match_count
        FROM songs_a s
             LEFT JOIN play_count p ON s.song_id = p.play_song_id AND s.track_id = p.play_track_id
             LEFT JOIN sim_count sc ON s.artist_id = sc.artist_id
             JOIN genre_a g ON s.artist_id = g.artist_id""",
    "q1": """
        SELECT s.artist_name, s.title, coalesce(d.td_confidence, 0) AS td_confidence,
               s.artist_hotness, s.song_hotness, coalesce(d.td_meanPrice, 0.0) AS td_meanPrice,
               d.td_artist IS NOT NULL AS has_download_record
        FROM serving_songs s
             LEFT JOIN dl_a d ON s.title = d.td_title AND s.artist_name = d.td_artist""",
    "wide_songs": """
        SELECT s.*, coalesce(p.play_count, 0) AS play_count, c.song_count,
               coalesce(w.weight_dot_freq, 0.0) AS weight_dot_freq,
               coalesce(sc.similar_artist_count, 0) AS similar_artist_count,
               coalesce(lk.likes, 0) AS likes, g.genre_match_count
        FROM songs_b s
             LEFT JOIN play_count p ON s.song_id = p.play_song_id AND s.track_id = p.play_track_id
             JOIN song_count_b c ON s.artist_id = c.artist_id
             LEFT JOIN wf_b w ON s.artist_id = w.artist_id
             LEFT JOIN sim_count sc ON s.artist_id = sc.artist_id
             LEFT JOIN likes lk ON s.track_id = lk.track
             JOIN genre_b g ON s.artist_id = g.artist_id""",
    "q2w": """
        SELECT d.td_confidence, s.artist_hotttnesss, s.artist_familiarity, s.loudness, s.tempo,
               s.duration, s.song_hotttnesss, coalesce(TRY_CAST(s.year AS DOUBLE), 0.0) AS year,
               s.play_count, s.song_count, s.weight_dot_freq, s.similar_artist_count, s.likes,
               d.td_meanPrice, s.genre_match_count,
               log10(greatest(s.artist_familiarity * s.song_count * s.similar_artist_count, 0.0)
                     + 1) AS popularity,
               d.td_downloads, d.td_artist AS artist_key, d.td_title, s.song_id
        FROM dl_b d JOIN wide_songs s ON d.td_title = s.title AND d.td_artist = s.artist_name""",
    "q2": f"SELECT {', '.join(WIDE)} FROM q2w",
    "explore_v": f"""
        SELECT {', '.join(c for c in WIDE if c != 'popularity')},
               CASE WHEN artist_familiarity * song_count * similar_artist_count > -1
                    THEN ln(1 + artist_familiarity * song_count * similar_artist_count)
               END AS popularity
        FROM q2 WHERE td_confidence > 1""",
    "li_pred": f"""
        SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice AS label,
               l_quantity * 1500 AS prediction,
               CASE WHEN {split_bucket('l_suppkey')} < 30 THEN 'test' ELSE 'train' END AS split
        FROM lineitem""",
    "li_text": """
        SELECT l_orderkey, l_linenumber, l_returnflag,
               CASE WHEN l_linenumber % 5 = 0 THEN 'NA'
                    ELSE CAST(l_extendedprice AS VARCHAR) END AS price_text,
               CASE WHEN l_linenumber % 5 = 1 THEN ''
                    ELSE CAST(l_discount AS VARCHAR) END AS discount_text
        FROM lineitem""",
})
FRAGMENTS.update(_term_rank("a", "s.artist_hotness", "songs_a", 1000))
FRAGMENTS.update(_term_rank("b", "s.raw_hotness", "raw_hot", 1000))


def _deps(sql: str, exclude: str | None = None) -> list[str]:
    return [n for n in FRAGMENTS if n != exclude and re.search(rf"\b{n}\b", sql)]


def with_fragments(body: str) -> str:
    """Prefix ``body`` with every fragment it needs (transitively), in dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str) -> None:
        if name in seen:
            return
        seen.add(name)
        for d in _deps(FRAGMENTS[name], exclude=name):
            visit(d)
        order.append(name)

    for n in _deps(body):
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({FRAGMENTS[n]})" for n in order)
    if body.lstrip().upper().startswith("WITH"):
        body = f"SELECT * FROM ({body}) AS _w"
    return f"WITH {ctes}\n{body}"


def rounded(body: str, doubles, digits: int = 6) -> str:
    """``body`` with the given double columns rounded (both sides round alike).

    ``doubles`` is a list of columns, or a dict column -> decimals."""
    if not doubles:
        return body
    spec = doubles if isinstance(doubles, dict) else {c: digits for c in doubles}
    rep = ", ".join(f"{fround(c, d)} AS {c}" for c, d in spec.items())
    return f"SELECT * REPLACE ({rep}) FROM ({body}) AS _r"
