"""The corpus operators' queries, and their SQL where SQL can express them."""

from . import bpe, chat, decontaminate, lines, lm, media, quality, secrets, simhash, suffix

QUERIES = {
    "op1_chat": chat.op1_chat,
    "op2_suffix": suffix.op2_suffix,
    "op3_secrets": secrets.op3_secrets,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_media": media.op5_media,
    "op6_simhash": simhash.op6_simhash,
    "op7_lm": lm.op7_lm,
    "op8_quality": quality.op8_quality,
    "op9_lines": lines.op9_lines,
    "op10_bpe": bpe.op10_bpe,
}

ORACLES = {
    "op1_chat": chat.SQL,
    "op3_secrets": secrets.SQL,
    "op4_decontaminate": decontaminate.SQL,
    "op7_lm": lm.SQL,
    "op9_lines": lines.SQL,
}
