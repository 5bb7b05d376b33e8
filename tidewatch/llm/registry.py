"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tidewatch.llm import bpe, conversations, decontaminate, html, language, lm, oracles, quality, secrets, simhash, subwords, tokens, toxicity, whitening

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_language": language.op2_language,
    "op3_tokens": tokens.op3_tokens,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_html": html.op5_html,
    "op6_lm": lm.op6_lm,
    "op7_bpe": bpe.op7_bpe,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_secrets": secrets.op9_secrets,
    "op10_quality": quality.op10_quality,
    "op11_quality_classifier": subwords.op11_quality_classifier,
    "op12_conversations": conversations.op12_conversations,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES: dict[str, str] = {
    "op9_secrets": oracles.SECRETS,
    "op12_conversations": oracles.CONVERSATIONS,
}
