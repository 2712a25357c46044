"""A run-length index: the Burrows-Wheeler transform of some texts as runs, with the suffix array sampled at the runs' ends."""

from __future__ import annotations

import numpy as np

STEP = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; ends as soon as all ranks differ."""
    n = len(text)
    text = text.astype(np.int64)
    width = 1
    if n and int(text.max()) < (1 << 15) - 1:  # four symbols fit one key: two rounds less
        padded = np.concatenate([text + 1, np.zeros(3, np.int64)])
        rank = np.unique((padded[:n] << 45) | (padded[1 : n + 1] << 30) | (padded[2 : n + 2] << 15) | padded[3 : n + 3], return_inverse=True)[1].astype(np.int64)
        width = 4
    else:
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + ahead
        order = np.argsort(key)
        sorted_ = key[order]
        new = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


class RunLengthIndex:
    """Over symbols >= 0; `texts` are laid end to end, each closed by a separator of its own.

    The transform is kept as runs (symbol, first row), the LF step of each run's first row, and the text positions of each
    run's first and last row.  The texts stay for comparing symbols directly.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        m = len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        self.text = np.empty(len(symbols) + m, np.int32)
        inner = np.ones(len(self.text), bool)
        inner[ends] = False
        self.text[inner] = symbols + m
        self.text[ends] = np.arange(m)
        self.shift = m
        order = suffix_array(self.text)
        last = self.text[order - 1]
        cut = np.concatenate([[True], last[1:] != last[:-1]])
        self.start = np.flatnonzero(cut)
        stop = np.append(self.start[1:], len(last))
        self.head = last[self.start].astype(np.int64)
        self.first_at, self.last_at = order[self.start], order[stop - 1]
        runs = np.arange(len(self.start))
        by_head = np.lexsort((runs, self.head))
        sizes = (stop - self.start)[by_head]
        # rows of the sorted first column are dealt to the runs by symbol, then place
        self.step = np.empty(len(runs), np.int64)
        self.step[by_head] = np.cumsum(sizes) - sizes
        self.keys = self.head[by_head] * len(runs) + runs[by_head]

    def _agree(self, at: np.ndarray, patterns: np.ndarray, column: int, most: np.ndarray) -> np.ndarray:
        """Symbols in which the text from `at` agrees with the patterns from `column`, up to `most`."""
        out = np.zeros(len(at), np.int64)
        live = np.flatnonzero(most > 0)
        width = patterns.shape[1]
        steps = np.arange(STEP)
        while len(live):
            done = out[live]
            cols = column + done[:, None] + steps
            rows = at[live][:, None] + done[:, None] + steps
            inside = (cols < width) & (rows < len(self.text)) & (done[:, None] + steps < most[live][:, None])
            same = inside & (self.text[np.minimum(rows, len(self.text) - 1)] == patterns[live[:, None], np.minimum(cols, width - 1)])
            run = np.where(same.all(1), STEP, np.argmin(same, 1))
            out[live] += run
            live = live[run == STEP]
        return out

    def matching_statistics(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each pattern and start, the length of the longest match with the texts; patterns are streamed side by side from their ends."""
        lanes, width = len(lengths), int(lengths.max(initial=0))
        patterns = np.full((lanes, width), -1, np.int64)
        patterns[np.arange(width) < lengths[:, None]] = symbols + self.shift
        out = np.zeros((lanes, width), np.int64)
        row, length, runs = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64), len(self.start)
        for column in range(width - 1, -1, -1):
            lane = np.flatnonzero(lengths > column)
            c, own = patterns[lane, column], row[lane]
            run = np.searchsorted(self.start, own, "right") - 1
            off = np.flatnonzero(self.head[run] != c)
            if len(off):
                lane_o, c_o, run_o = lane[off], c[off], run[off]
                place = np.searchsorted(self.keys, c_o * runs + run_o)
                best, best_run, best_row = np.full(len(off), -1, np.int64), run_o.copy(), own[off].copy()
                for which, at_sample in ((place, self.first_at), (place - 1, self.last_at)):
                    key = self.keys[np.clip(which, 0, runs - 1)]
                    good = np.flatnonzero((which >= 0) & (which < runs) & (key // runs == c_o))
                    near = key[good] % runs
                    got = self._agree(at_sample[near], patterns[lane_o[good]], column + 1, length[lane_o[good]])
                    better = got > best[good]
                    g, r = good[better], near[better]
                    best[g], best_run[g] = got[better], r
                    best_row[g] = self.start[r] if at_sample is self.first_at else (np.append(self.start[1:], len(self.text))[r] - 1)
                length[lane_o] = best
                run[off], own[off] = best_run, best_row
            lost = length[lane] < 0
            row[lane] = np.where(lost, 0, self.step[run] + own - self.start[run])
            length[lane] = np.where(lost, 0, length[lane] + 1)
            out[lane, column] = length[lane]
        return out
