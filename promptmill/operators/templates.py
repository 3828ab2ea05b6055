"""Chat templates stated as rules and compiled into one Spark expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptmill.functions.text import strip

SYSTEM = "system"


@dataclass(frozen=True)
class MessageRule:
    """How the messages that it fits are written. ``None`` fits all.

    ``{role}`` in ``before`` stands for the role, after ``Template.rename``.
    ``first`` and ``last`` ask whether the message opens or closes the conversation.
    """

    role: str | None = None
    first: bool | None = None
    last: bool | None = None
    before: str = ""
    after: str = ""
    trim: bool = False


@dataclass(frozen=True)
class Template:
    """A conversation's text: ``begin``, the messages by the first rule that fits each, ``end``.

    A message that no rule fits is left out. ``default_system`` opens conversations that do not open with a
    system message. With ``fold_system`` (text before and after) an opening system message is not
    written on its own but put in front of the content of the message that follows, which is trimmed alone, or,
    with ``trim_folded``, as a whole; without one that follows it is left out. ``generation`` is added where an
    answer is asked for, in place of ``end``.
    """

    rules: tuple[MessageRule, ...]
    begin: str = ""
    end: str = ""
    generation: str = ""
    default_system: str | None = None
    fold_system: tuple[str, str] | None = None
    trim_folded: bool = False
    rename: tuple[tuple[str, str], ...] = ()

    def text(self, messages: Column, add_generation_prompt: bool = False) -> Column:
        """Messages as one string. A missing role or content is empty text; NULL messages give NULL."""
        head = F.get(messages, F.lit(0))
        opens = F.coalesce(head["role"] == SYSTEM, F.lit(False))
        system = F.when(opens, F.coalesce(head["content"], F.lit("")))
        rest, shift, lead = messages, F.lit(0), F.lit("")
        if self.default_system is not None:
            system = system.otherwise(self.default_system)
        if self.fold_system is not None:
            rest = F.when(opens, F.slice(messages, 2, F.greatest(F.size(messages), F.lit(1)))).otherwise(messages)
            count = F.size(messages) - opens.cast("int")
        else:
            if self.default_system is not None:
                shift = (~opens).cast("int")
                added = self._message(F.lit(SYSTEM), F.lit(self.default_system), F.lit(0), F.size(messages) + 1, None)
                lead = F.when(opens, "").otherwise(added)
            count, system = F.size(messages) + shift, None

        def written(message: Column, i: Column) -> Column:
            role, content = (F.coalesce(message[name], F.lit("")) for name in ("role", "content"))
            return self._message(role, content, i + shift, count, system)

        body = F.array_join(F.transform(rest, written), "")
        close = self.generation if add_generation_prompt else self.end
        return F.concat(F.lit(self.begin), lead, body, F.lit(close))

    def _message(self, role: Column, plain: Column, place: Column, count: Column, system: Column | None) -> Column:
        out = F.lit("")
        for rule in reversed(self.rules):
            content = strip(plain) if rule.trim else plain
            if system is not None:
                before, after = map(F.lit, self.fold_system)
                put = F.concat(before, system, after, plain if self.trim_folded else content)
                put = strip(put) if rule.trim and self.trim_folded else put
                content = F.when((place == 0) & system.isNotNull(), put).otherwise(content)
            fits = F.lit(True)
            if rule.role is not None:
                fits &= role == rule.role
            if rule.first is not None:
                fits &= (place == 0) == F.lit(rule.first)
            if rule.last is not None:
                fits &= (place == count - 1) == F.lit(rule.last)
            out = F.when(fits, F.concat(self._before(rule, role), content, F.lit(rule.after))).otherwise(out)
        return out

    def _before(self, rule: MessageRule, role: Column) -> Column:
        parts = rule.before.split("{role}")
        named = role
        for old, new in self.rename:
            named = F.when(role == old, new).otherwise(named)
        pieces = [F.lit(parts[0])]
        for part in parts[1:]:
            pieces += [named, F.lit(part)]
        return F.concat(*pieces)


def marked(before_role: str, after_role: str, after_content: str, generation: str, **options) -> Template:
    """The one form in which markers stand around every role and content."""
    rule = MessageRule(before=f"{before_role}{{role}}{after_role}", after=after_content)
    return Template((rule,), generation=generation, **options)


# Public template forms.
CHATML = marked("<|im_start|>", "\n", "<|im_end|>\n", "<|im_start|>assistant\n")
CHATML_ASSISTANT = marked(
    "<|im_start|>", "\n", "<|im_end|>\n", "<|im_start|>assistant\n", default_system="You are a helpful assistant."
)
INST = Template(
    rules=(
        MessageRule(role="user", before="<s>[INST] ", after=" [/INST]", trim=True),
        MessageRule(role="assistant", before=" ", after=" </s>", trim=True),
    ),
    fold_system=("<<SYS>>\n", "\n<</SYS>>\n\n"),
    trim_folded=True,
)
TURNS = Template(
    rules=(MessageRule(before="<start_of_turn>{role}\n", after="<end_of_turn>\n", trim=True),),
    begin="<bos>",
    generation="<start_of_turn>model\n",
    fold_system=("", "\n\n"),
    rename=(("assistant", "model"),),
)
