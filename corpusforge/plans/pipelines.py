"""The pipelines a user runs: each takes and returns DataFrames, with a stub for every generated text unless a generator is given."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sentences as S
from ..functions import text as T
from ..functions.text import seeded_hash
from ..operators import conversations as C
from ..operators import generate as G
from ..operators import judging as J
from ..operators import packing, preference, sampling
from ..operators.blending import blend, union_pools
from ..runtime import Workspace

#: What is asked where the caller brings nothing of their own: questions on a case, what-if templates with their fillings, and openings for a continuation.
TREATMENT_QUESTIONS = (
    "Which course of action fits this case best, and on what grounds?",
    "Name the findings that weigh most in deciding what to do here.",
    "How is a case like this one usually handled, and which other ways are worth a thought?",
    "How serious is this case, and how does that bear on the choice?",
    "Which difficulties should one prepare for in this case?",
)
WHATIF = {
    "condition": ("Suppose {condition} were present as well. What would you change?", ("a kidney disorder", "a weak heart", "unstable blood sugar", "a liver disorder", "an earlier serious illness")),
    "age": ("Suppose this were {age}. Would you decide in the same way?", ("a frail person over eighty", "a student of twenty", "a child of nine")),
    "finding": ("A further test shows {finding}. Does that alter the plan?", ("an inherited variant", "an unstable genome", "resistance to the first choice", "a strong immune marker", "a rare mutation", "a gene fusion")),
    "history": ("Earlier attempts were {history}. What comes next?", ("one standard course without effect", "two different courses without effect", "an incomplete operation")),
    "spread": ("It is now found in {spread} too. How does the plan change?", ("the brain", "the liver", "the bones", "the other lung")),
}
INSTRUCTIONS = (
    "Here is how a text begins. Write on from where it stops:",
    "Take up this fragment and bring it to its end in the same voice:",
    "The following lines break off. Supply what should come after them:",
    "Go on with this text; keep to its subject and its terms:",
    "Finish what this author has started:",
)
QUESTIONS, BEYOND_QUESTIONS, BEYOND_SHARE, CORRECTION_SHARE = 3, 2, 0.3, 0.15
#: System messages of the phases that answer; questions and verdicts are asked for without one.
SYSTEMS = {
    "answer": "You answer from a given text on {kind} and from nothing else.", "beyond_answer": "You answer questions on {kind} with care and say what the text leaves open.",
    "flawed": "You write an answer on {kind} with one plausible mistake.", "correction": "You check an answer on {kind} against its source and put it right.", "treatment": "You reason about a case step by step.",
    "strict_answer": "You answer on {kind} with what the text says, word for word where you can.", "hallucinated": "You write a confident answer on {kind} that the text does not support.",
    "beyond_chosen": "You say plainly what a text on {kind} cannot tell, and what it can.",
}
ANSWER_PROMPT = "Answer from this text on {kind}.\n---\n{chunk}\n---\nQuestion: {question}"
QUESTION_PROMPT = 'Write exactly {n} questions on {kind} that this text answers.\n---\n{chunk}\n---\nReply as JSON: {{"questions": ["...", ...]}}'
JUDGE_PROMPT = "Text:\n{chunk}\n\nQuestion: {question}\nAnswer: {answer}\n\nEnd with VERDICT: GROUNDED, VERDICT: EXTRAPOLATED or VERDICT: HALLUCINATED."


@dataclass(frozen=True)
class Phase:
    """How the texts of a phase are made: by a generator, or by the stub's expression."""

    generator: G.Generator | None = None

    def reply(self, df: DataFrame, name: str, phase: str, prompt: Column, stub: Column, kind: Column | None = None) -> DataFrame:
        """df plus the phase's reply; its system message, if it has one, is filled with the type's name."""
        if self.generator is None:
            return df.withColumns({name: stub, f"{name}_status": F.lit("ok")})
        system = G.fill(SYSTEMS[phase], kind=T.display_name(kind) if kind is not None else F.lit("the subject")) if phase in SYSTEMS else None
        return Workspace(df.sparkSession).write(G.call(df, prompt, self.generator, phase, name, system), name)  # asked once, however often the replies are read


STUB = Phase()


def chunk_table(df: DataFrame, id_col: str, text: str, kind: str, size: int = S.CHUNK, overlap: int = S.OVERLAP) -> DataFrame:
    """One row for each chunk, made once: (id, ix, chunk, chunk_key, kind). Everything downstream reads this table."""
    rows = df.select(F.col(id_col), F.col(kind), F.posexplode(S.chunks(F.col(text), size, overlap)).alias("ix", "chunk"))
    return rows.withColumn("chunk_key", T.key_prefix(F.col("chunk")))


def chunk_statistics(df: DataFrame, chunks: DataFrame, id_col: str, kind: str, questions: int = QUESTIONS, rounds: int = 1) -> DataFrame:
    """Records, chunks, whole-number average length and expected questions and conversations, by kind and in total."""
    counts = chunks.groupBy(id_col).agg(F.count("*").alias("c"), F.sum(F.length("chunk")).alias("s"))
    joined = df.select(id_col, kind).join(counts, id_col, "left").fillna({"c": 0, "s": 0})
    out = joined.rollup(kind).agg(F.count("*").alias("records"), F.sum("c").alias("chunks"), F.floor(F.sum("s") / F.greatest(F.sum("c"), F.lit(1))).cast("long").alias("avg_chars"), F.grouping(kind).alias("__g"))
    return out.select(F.when(F.col("__g") == 1, "TOTAL").otherwise(F.col(kind)).alias(kind), "records", "chunks", "avg_chars", (F.col("chunks") * questions * rounds).alias("est_qa"), F.floor(F.col("chunks") * questions * rounds / C.TURNS).cast("long").alias("est_conversations"))


def generate_qa(chunks: DataFrame, id_col: str, kind: str, round_: int = 0, n: int = QUESTIONS, phase: Phase = STUB, keep_thinking: bool = True) -> DataFrame:
    """(id, ix, question_ix, question, answer, chunk_key, kind, round): questions of each chunk and their answers of quality."""
    asked = phase.reply(chunks, "__q", "questions", G.fill(QUESTION_PROMPT, n=F.lit(n), kind=F.col(kind), chunk=F.col("chunk")), G.stub_questions(F.col("chunk"), n, round_))
    each = asked.select(id_col, "ix", kind, "chunk", "chunk_key", F.posexplode(T.parse_questions(F.col("__q"))).alias("question_ix", "question"))
    told = phase.reply(each, "__a", "answer", G.fill(ANSWER_PROMPT, kind=F.col(kind), chunk=F.col("chunk"), question=F.col("question")), G.stub_answer(F.col("chunk"), F.col("question")), F.col(kind))
    answer = T.process_answer(F.col("__a"), keep_thinking)
    return told.where(~T.is_low_quality(answer)).select(id_col, "ix", "question_ix", "question", answer.alias("answer"), "chunk", "chunk_key", kind, F.lit(round_).alias("round"))


def ground(items: DataFrame, phase: Phase = STUB, strict: bool = False) -> DataFrame:
    """items (question, answer, chunk) plus grounding_verdict. Leaked answers are never sent to the judge."""
    leaked = T.is_leaked(F.col("answer"), strict)
    if phase.generator is None:
        return J.verdicts(items, "answer", G.stub_verdict(F.col("answer"), F.col("chunk")), strict)
    asked = phase.reply(items.where(~leaked), "__v", "judge", G.fill(JUDGE_PROMPT, chunk=F.col("chunk"), question=F.col("question"), answer=J.judged_text(F.col("answer"))), F.lit(None))
    judged = asked.withColumn("grounding_verdict", T.parse_verdict(F.col("__v"))).select(*items.columns, "grounding_verdict")
    return judged.unionByName(items.where(leaked).withColumn("grounding_verdict", F.lit("leaked_reference")))


def beyond_evidence(chunks: DataFrame, id_col: str, kind: str, key: str, seed: str | int = "beyond", share: float = BEYOND_SHARE, phase: Phase = STUB) -> DataFrame:
    """Questions that a sample of chunks can't answer, with careful answers."""
    sampled = sampling.fraction(chunks, kind, share, seed, key)
    asked = phase.reply(sampled, "__q", "beyond_questions", G.fill(QUESTION_PROMPT, n=F.lit(BEYOND_QUESTIONS), kind=F.col(kind), chunk=F.col("chunk")), G.stub_questions(F.col("chunk"), BEYOND_QUESTIONS, 8))
    each = asked.select(id_col, "ix", kind, "chunk", "chunk_key", F.posexplode(T.parse_questions(F.col("__q"), BEYOND_QUESTIONS, 15)).alias("question_ix", "question"))
    told = phase.reply(each, "__a", "beyond_answer", G.fill(ANSWER_PROMPT, kind=F.col(kind), chunk=F.col("chunk"), question=F.col("question")), G.stub_answer(F.col("chunk"), F.col("question")), F.col(kind))
    answer = T.process_answer(F.col("__a"))
    return told.where(~T.is_low_quality(answer)).select(id_col, "ix", "question_ix", kind, "question", answer.alias("answer"), "chunk_key", T.has_thinking(answer).alias("has_thinking"), F.lit("beyond_evidence").alias("qa_type"))


def self_corrections(items: DataFrame, kind: str, key: str, seed: str | int = "correct", share: float = CORRECTION_SHARE, phase: Phase = STUB) -> DataFrame:
    """Five-turn conversations for a sample of items (question, chunk): a flawed answer, doubt, and the correction."""
    sampled = sampling.fraction(items, kind, share, seed, key)
    flawed = phase.reply(sampled, "__f", "flawed", G.fill(ANSWER_PROMPT, kind=F.col(kind), chunk=F.col("chunk"), question=F.col("question")), G.stub_flawed(F.col("chunk"), F.col("question")), F.col(kind))
    flawed = flawed.withColumns({"__f": T.strip_thinking(F.col("__f")), "__p": T.pick(C.PUSHBACKS, seeded_hash(f"{seed}:pushback", F.col(key)))}).where(F.length("__f") >= 50)
    fixed = phase.reply(flawed, "__c", "correction", G.fill(ANSWER_PROMPT + "\n{doubt}", kind=F.col(kind), chunk=F.col("chunk"), question=F.col("question"), doubt=F.col("__p")), G.stub_correction(F.col("chunk"), F.col("question"), F.col("__p")), F.col(kind))
    correction = T.process_answer(F.col("__c"))
    conv = C.correction_turns(C.system_prompt(F.col(kind)), F.col("question"), F.col("__f"), F.col("__p"), correction)
    return fixed.where(~T.is_low_quality(correction)).select(key, conv.alias("conversations"), F.lit("self_correction").alias("data_type"), kind, T.has_thinking(correction).alias("has_thinking"))


def patient_questions(patients: DataFrame, key: str, seed: str | int = "patient", direct: int = 3, whatif: int = 2, questions: tuple[str, ...] = TREATMENT_QUESTIONS, templates: dict[str, tuple[str, tuple[str, ...]]] = WHATIF) -> DataFrame:
    """(patient's columns, question, question_type): `direct` of the questions and `whatif` of the templates, each filled at random."""
    k = F.col(key)
    chosen = sampling.choose(F.array(*map(F.lit, questions)), direct, f"{seed}:direct", k)
    names = sampling.choose(F.array(*map(F.lit, templates)), whatif, f"{seed}:whatif", k)
    filled = lambda name: F.coalesce(*[F.when(name == n, F.replace(F.lit(t), F.lit("{" + n + "}"), T.pick(fills, seeded_hash(f"{seed}:{n}", k)))) for n, (t, fills) in templates.items()])
    both = F.concat(F.transform(chosen, lambda q: F.struct(q.alias("question"), F.lit("direct").alias("question_type"))), F.transform(names, lambda n: F.struct(filled(n).alias("question"), F.lit("whatif").alias("question_type"))))
    return patients.select("*", F.posexplode(both).alias("question_ix", "__q")).select("*", "__q.*").drop("__q")


def treatment_reasoning(patients: DataFrame, key: str, note: str, least: int = 100, phase: Phase = STUB) -> DataFrame:
    """Reasoned answers on patients with a note of `least` characters or more."""
    asked = patient_questions(patients.where(F.length(note) >= least), key)
    told = phase.reply(asked, "__a", "treatment", G.fill("Patient Case:\n{note}\n\nQuestion: {question}", note=F.col(note), question=F.col("question")), G.stub_answer(F.col(note), F.col("question")))
    answer = T.process_answer(F.col("__a"))
    return told.where(~T.is_low_quality(answer)).select(F.col(key).alias("patient_id"), "question_ix", "question", answer.alias("answer"), T.key_prefix(F.col(note)).alias("patient_note_key"), "question_type", T.has_thinking(answer).alias("has_thinking"))


def continuations(df: DataFrame, id_col: str, text: str, kind: str, seed: str | int = "continue", chunk: int = S.TOKEN_CHUNK, start: int = S.SEED_TOKENS, least: int = S.LEAST_COMPLETION, count: Callable[[str], int] | None = None) -> DataFrame:
    """(id, ix, instruction, seed, completion, conversations, data_type, kind) of chunks that can be split with a completion of `least` characters."""
    rows = df.select(id_col, kind, F.posexplode(S.token_chunks(F.col(text), chunk, count)).alias("ix", "chunk"))
    split = rows.withColumn("__s", S.seed_completion(F.col("chunk"), start, count)).where(F.length("__s.completion") >= least)
    told = T.pick(INSTRUCTIONS, seeded_hash(seed, F.col(id_col), F.col("ix")))
    human = F.concat(told, F.lit('\n\n"'), F.col("__s.seed"), F.lit('"'))
    return split.select(id_col, "ix", told.alias("instruction"), "__s.seed", "__s.completion", C.three_turns(C.system_prompt(F.col(kind)), human, F.col("__s.completion")).alias("conversations"), F.lit("continuation").alias("data_type"), kind)


def single_turns(items: DataFrame, kind: str, data_type: str, keep: list[str]) -> DataFrame:
    conv = C.three_turns(C.system_prompt(F.col(kind)), F.col("question"), F.col("answer"))
    return items.select(*keep, conv.alias("conversations"), F.lit(data_type).alias("data_type"), kind).where(C.is_good(F.col("conversations")))


def merge(pools: list[DataFrame], key: str, seed: str | int = 42, shares: dict[str, float] | None = None, bag_union: bool = True) -> DataFrame:
    """All pools blended to their shares. `bag_union` keeps rows that come in several pools, as published."""
    return blend(union_pools(pools, None if bag_union else [key]), seed, key, shares=shares)


def collect_preferences(items: DataFrame, kind: str, key: str, phase: Phase = STUB) -> DataFrame:
    """Pairs of a strictly grounded and a made-up answer for items (question, chunk); the chunk '' where it isn't known."""
    strict = phase.reply(items, "__chosen", "strict_answer", G.fill(ANSWER_PROMPT, kind=F.col(kind), chunk=F.col("chunk"), question=F.col("question")), G.stub_answer(F.col("chunk"), F.col("question")), F.col(kind))
    bad = phase.reply(strict, "__rejected", "hallucinated", G.fill(ANSWER_PROMPT, kind=F.col(kind), chunk=F.col("chunk"), question=F.col("question")), G.stub_flawed(F.col("chunk"), F.col("question")), F.col(kind))
    return preference.pairs(bad, C.system_prompt(F.col(kind)), F.col("question"), T.process_answer(F.col("__chosen")), T.strip_thinking(F.col("__rejected")), "hallucination", [key, kind])


def beyond_preferences(items: DataFrame, kind: str, key: str, phase: Phase = STUB) -> DataFrame:
    """Pairs for questions that a chunk can't answer (question, chunk): the chosen answer is made anew and says where the evidence ends, the rejected one is made up."""
    prompt = G.fill(ANSWER_PROMPT, kind=F.col(kind), chunk=F.col("chunk"), question=F.col("question"))
    chosen = phase.reply(items, "__chosen", "beyond_chosen", prompt, G.stub_limits(F.col("chunk"), F.col("question")), F.col(kind))
    bad = phase.reply(chosen, "__rejected", "hallucinated", prompt, G.stub_flawed(F.col("chunk"), F.col("question")), F.col(kind))
    return preference.pairs(bad, C.system_prompt(F.col(kind)), F.col("question"), T.process_answer(F.col("__chosen")), T.strip_thinking(F.col("__rejected")), "beyond_evidence", [key, kind])


def correction_preferences(corrections: DataFrame, kind: str, keep: list[str]) -> DataFrame:
    """Pairs from five-turn conversations: the correction is preferred to the flawed answer."""
    conv = F.col("conversations")
    there = corrections.where(F.size(conv) >= 5)
    return preference.pairs(there, C.value_at(conv, 0, "system"), C.value_at(conv, 1, "human"), C.value_at(conv, 4, "gpt"), T.strip_thinking(C.value_at(conv, 2, "gpt")), "self_correction", keep)


def prepare_sft(df: DataFrame, position: str, block: int, most: int | None = None, stratum: str = "cancer_type", seed: str | int = 42, tokens: Callable[[Column], Column] = T.approximate_tokens) -> tuple[DataFrame, DataFrame]:
    """(rows with text and token span, packing report): quota, removal of empty ends, template, offsets. Rows of wrong format are reported elsewhere and stay."""
    rows = sampling.equal_quota(df, stratum, most, seed, position) if most else df
    rows = rows.where(~C.has_empty_end(F.col("conversations")))
    text = rows.withColumn("text", preference.chat_template(C.to_messages(F.col("conversations"))))
    return packing.offsets(text, position, tokens(F.col("text"))), packing.report(text, tokens(F.col("text")), block)


def prepare_dpo(df: DataFrame, key: str, most: int, budget: int, seed: str | int = 3407, tokens: Callable[[Column], Column] = T.approximate_tokens) -> DataFrame:
    """Stratified, checked, rendered and length-filtered pairs."""
    capped = sampling.source_cap(df, "source", most, seed, key)
    good = capped.where(preference.prefix_ok(F.col("chosen"), F.col("rejected")))
    return preference.within_budget(preference.split_texts(good, [key, "source"]), budget, tokens)


def verify(df: DataFrame) -> DataFrame:
    """Format errors of conversations by data type."""
    error = C.format_error(F.col("conversations"))
    return df.groupBy("data_type").agg(F.count("*").alias("n"), F.count_if(error.isNotNull()).alias("n_errors"), F.count_if(C.has_empty_end(F.col("conversations"))).alias("n_empty_ends"))
