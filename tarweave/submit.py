"""Run a job with ``spark-submit``:

    spark-submit tarweave/submit.py process spec.yaml --decode my_codecs:decode
    spark-submit tarweave/submit.py caption --model-path org/name --data-path /in \\
        --output-dir /out --prompt "Describe." --model my_models:make_model

Plug-ins are named ``module:function``; ship their modules with ``--py-files``.
``--task-gpus``, ``--task-cpus``, ``--executor-memory`` and the like are resources of
the one stage that runs the codec or the model (see ``stage_resources``).
"""

from __future__ import annotations

import argparse
import importlib
import math
import os
import sys

from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarweave.plans.captioning import caption_shards  # noqa: E402
from tarweave.plans.spec import run_spec  # noqa: E402


def plug_in(name: str | None):
    if not name:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def stage_resources(options: dict) -> ResourceProfile | None:
    """Resources of the stage with the plug-in; None when none are asked for. Takes its options out of ``options``."""
    given = {name: options.pop(name) for name in ("task_cpus", "task_gpus", "executor_cores", "executor_memory", "executor_gpus", "gpu_script")}
    if all(value is None for name, value in given.items() if name != "gpu_script"):
        return None
    task, executor = TaskResourceRequests(), ExecutorResourceRequests()
    if given["task_cpus"]:
        task.cpus(given["task_cpus"])
    if given["task_gpus"]:
        task.resource("gpu", given["task_gpus"])
        # Several tasks may share a GPU; an executor has one at least.
        executor.resource("gpu", given["executor_gpus"] or max(1, math.ceil(given["task_gpus"])), given["gpu_script"] or "")
    if given["executor_cores"]:
        executor.cores(given["executor_cores"])
    if given["executor_memory"]:
        executor.memory(given["executor_memory"])
    build = ResourceProfileBuilder().require(task)
    if executor.requests:
        build = build.require(executor)
    return build.build


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tarweave")
    jobs = top.add_subparsers(dest="job", required=True)
    process = jobs.add_parser("process", help="filter and map shards by a specification")
    process.add_argument("spec")
    caption = jobs.add_parser("caption", help="caption shards with a model plug-in")
    for option in ("model-path", "data-path", "prompt", "model"):
        caption.add_argument(f"--{option}", required=True)
    caption.add_argument("--output-dir", default="output")
    caption.add_argument("--meta-key", default="info.json")
    caption.add_argument("--backend", default="vllm")
    caption.add_argument("--max-tokens", type=int, default=128)
    caption.add_argument("--temperature", type=float, default=0.6)
    caption.add_argument("--batch-size", type=int, default=32)
    caption.add_argument("--max-model-len", type=int, default=4096)
    caption.add_argument("--language-only", action="store_true")
    caption.add_argument("--language-only-key")
    caption.add_argument("--meta-wins", action="store_true")
    caption.add_argument("--image-encoder")
    caption.add_argument("--text-encoder")
    for job in (process, caption):
        job.add_argument("--decode")
        job.add_argument("--debug", action="store_true")
        job.add_argument("--limit", type=int)
        job.add_argument("--drop-tail", dest="keep_partial", action="store_false")
        job.add_argument("--retry-rejected", action="store_true")
        job.add_argument("--task-cpus", type=int)
        job.add_argument("--task-gpus", type=float)
        job.add_argument("--executor-cores", type=int)
        job.add_argument("--executor-memory")
        job.add_argument("--executor-gpus", type=int)
        job.add_argument("--gpu-script", help="the script by which an executor finds its GPUs")
    return top


def main(argv: list[str] | None = None) -> None:
    options = vars(parser().parse_args(argv))
    job = options.pop("job")
    options["decode"] = plug_in(options["decode"])
    resources = stage_resources(options)
    spark = SparkSession.builder.appName(f"tarweave {job}").getOrCreate()
    if job == "process":
        outcome = run_spec(spark, options.pop("spec"), profile=resources, **options)
        print(outcome.seen)
        return
    options["make_model"] = plug_in(options.pop("model"))
    for side in ("image_encoder", "text_encoder"):
        options[side] = plug_in(options[side])
    outcome = caption_shards(spark, profile=resources, **options)
    if outcome.average is not None:
        outcome.average.show()


if __name__ == "__main__":
    main()
