"""A small labelled table, written by hand: forms of personal data that the detectors miss, and what looks like them.

A form's span stands between double braces after its kind. Every form is put into every frame, at the place of ``%s``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

FRAMES = (
    "%s", "please call %s today", "Reach us, %s.", "and then %s again", "ask Anna Berg, %s, or Tom",
    "écrivez à %s demain", "UND %s MIT", "see (below) %s; thanks", "no. 7 %s for 2 people",
    "連絡先%sです", "<td>%s</td>", "id=4&to=%s&by=9;",
)
SPANS = (
    "{{phone 555-123-4567}}", "{{phone (555) 123-4567}}", "{{phone (555)123-4567}}", "{{phone 555.123.4567}}",
    "{{phone 1-800-555-0199}}", "{{phone 1 (555) 123-4567}}", "tel {{phone 030 1234567}}", "Tel.: {{phone 555 123 4567}}",
    "phone {{phone 0171 2345678}}", "fax: {{phone 01 23 45 67 89}}", "mobile {{phone 0171-2345678}}",
    "{{email jane (at) example (dot) org}}", "{{email jane.doe [at] mail [dot] example [dot] com}}",
    "{{email jane(at)example.org}}", "{{email jane.doe[at]example[dot]org}}", "{{email j_doe7 (at) example.org}}",
    "{{email jane7 [at] example.co.uk}}",
    "{{card 4111.1111.1111.1111}}", "{{card 4111_1111_1111_1111}}", "{{card 4111/1111/1111/1111}}",
    "{{ip 192[.]168[.]0[.]1}}", "{{ip 10[.]0[.]0[.]1}}", "{{ip 172.16.254[.]3}}",
)
OTHERS = (
    "2024-03-15", "15-03-2024", "15.03.2024", "3.5.2024", "2024/03/15", "10:30", "2024-03-15T10:30:00", "$1,299.00",
    "1.299,00", "EUR 49.90", "v2.10.3", "2.10.3", "2.10.3.4711", "1990-1995", "12-14", "978-3-16-148410-0", "12 345 678",
    "555 123 4567 units", "1,234,567", "3.14159", "50%", "#4821", "A4", "4111.1111.1111.1112", "4111_1111_1111_1112",
    "300.1.2.3", "300[.]1[.]2[.]3", "+5", "100+", "C++", "user@", "@home", "(sic)", "[1]", "(12)", "(2024) 15-20", "007",
    "1/2", "24/7", "INV-2024-00017", "1-2-3", "100-200-300", "12-34-56", "3-3-5", "10.1000/182", "looked (at) it",
    "it [at] noon", "tel 3", "call 24", "phone 2.0", "fax 2024-03-15",
)

_SPAN = re.compile(r"\{\{(\w+) (.*?)\}\}")


def texts() -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """(text, spans (kind, begin, end)) of every form in every frame."""
    for form in (*SPANS, *OTHERS):
        for frame in FRAMES:
            marked, text, spans, at = frame.replace("%s", form), "", [], 0
            for m in _SPAN.finditer(marked):
                text += marked[at:m.start()]
                spans.append((m[1], len(text), len(text) + len(m[2])))
                text += m[2]
                at = m.end()
            yield text + marked[at:], spans
