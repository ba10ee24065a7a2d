"""Small pure-Python oracles for the segmentation semantics (used by the fuzz tests)."""

import re


def segments_dotall(text):
    out = []
    for i, part in enumerate(re.split(r"(<image>.*?</image>)", text, flags=re.DOTALL)):
        if i % 2 == 1:
            out.append(("image", part[len("<image>"):-len("</image>")].strip()))
        elif part.strip():
            out.append(("text", part.strip()))
    return out


def segments_strict(text):
    out = []
    for i, part in enumerate(re.split(r"<image>(.*?)</image>", text)):
        if part.strip():
            out.append(("image" if i % 2 else "text", part.strip()))
    return out


def layout_a(text):
    """(question, solution) lists of (type, content, index) by walking the segments."""
    q, s = [], []
    in_sol = False
    qi = si = 0
    for typ, c in segments_strict(text):
        if typ == "text":
            if not in_sol:
                if q:
                    in_sol = True
                    s.append(("text", c, None))
                else:
                    q.append(("text", c, None))
            else:
                s.append(("text", c, None))
        else:
            if not in_sol:
                q.append(("image", c, qi)); qi += 1; in_sol = True
            else:
                s.append(("image", c, si)); si += 1
    return q, s


def layout_b(text):
    segs = segments_dotall(text)
    f = next((i for i, (t, _) in enumerate(segs) if t == "image"), None)
    if f is None:
        return None
    sol, k = [], 0
    for t, c in segs[f + 1:]:
        if t == "image":
            sol.append(("image", c, k)); k += 1
        else:
            sol.append(("text", c, None))
    return segs[f][1], sol


def special_labels(entries):
    """Solution-section label per kept text entry; lookahead on the unfiltered list."""
    out = []
    for i, (t, c) in enumerate(entries):
        if t == "text" and c and c.strip():
            if i + 1 < len(entries) and entries[i + 1][0] == "image":
                out.append("vision_start")
            elif i == len(entries) - 1:
                out.append("endoftext")
            else:
                out.append("im_start")
    return out
