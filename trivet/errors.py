"""Errors that callers can tell apart. Tables of many objects carry a status and an error column instead."""

from __future__ import annotations

# The names of the errors and what they are kinds of, as callers catch them.


class MeshError(Exception):
    """Any failure of work on meshes."""


class MeshLoadError(MeshError):
    """A file's bytes are no mesh."""


class MeshFormatError(MeshError, ValueError):
    """A kind of file that is not known."""


class MeshInvalidError(MeshError, ValueError):
    """Too few vertices or faces to work on."""


class MeshProcessingError(MeshError):
    """Cleaning, filtering or repair went wrong, or a written file does not hold its mesh."""


class ScalingError(Exception):
    """Any failure of scaling."""


class ScalingConfigError(ScalingError, ValueError):
    """A setting of scaling that is not valid or not known."""


class ReferenceDetectionError(ScalingError):
    """No reference was found, or its data are broken."""


class ReferenceMeasurementError(ScalingError, ValueError):
    """A measured length that is missing or impossible."""


class ScaleEstimationError(ScalingError, ValueError):
    """A factor that is not finite and above 0."""


class MeshScalingError(ScalingError):
    """The transform could not be applied."""


class MeshScalingValidationError(ScalingError):
    """A scaled mesh whose counts or extents are not those expected."""


class ReconstructionError(Exception):
    """Any failure of an engine's job."""


class ReconstructionBinaryNotFoundError(ReconstructionError):
    """The engine's program is not on this machine."""


class ReconstructionInvalidInputError(ReconstructionError, ValueError, FileNotFoundError):
    """No frames, or frames that are missing or of another kind."""


class ReconstructionExecutionError(ReconstructionError):
    """The program ended with an error."""


class ReconstructionTimeoutError(ReconstructionExecutionError):
    """The program did not end in time."""


class ReconstructionArtifactNotFoundError(ReconstructionError):
    """The program ended well, but its output is missing."""


class ReconstructionPartialError(ReconstructionError):
    """Some output is there, but no mesh."""
