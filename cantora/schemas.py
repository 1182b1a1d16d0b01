"""Schemas of the tables that stages hand to each other."""

from __future__ import annotations

ALIGNED = "start double, end double, global_start double, global_end double, score double, chars_per_sec double, whisper_text string, matched_text string"
WORD = "struct<word:string,start:double,end:double,probability:double,score:double>"
WORD_ROW = f"index int, audio string, text_expected string, original_start double, original_end double, cut_start double, cut_end double, segments array<struct<start:double,end:double,text:string,words:array<{WORD}>>>, words array<{WORD}>"
DONE_LOG = "input string, output string, done_at string"
