"""Views of meshes: cameras, ray casting, shading, supersampling and tiling, in one kernel per mesh; PNG by zlib alone."""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .packed import Mesh, map_meshes

FOV_DEG, DISTANCE = 35.0, 2.5
#: Directions and up vectors of the six views, and the light model.
VIEWS = {"front": ((0, 0, 1), (0, 1, 0)), "back": ((0, 0, -1), (0, 1, 0)), "right": ((1, 0, 0), (0, 1, 0)), "left": ((-1, 0, 0), (0, 1, 0)), "top": ((0, 1, 0), (0, 0, -1)), "bottom": ((0, -1, 0), (0, 0, 1))}
KEY_DIR, KEY_COLOR = (-0.4, -0.6, -0.7), (1.0, 0.98, 0.94)
FILL_DIR, FILL_COLOR = (0.6, 0.2, 0.3), (0.5, 0.55, 0.65)
AMBIENT, BASE, BACKGROUND = 0.22, 0.72, 1.0
FOUR = ("front", "right", "back", "left")
SIX = {"+X": "right", "+Y": "top", "+Z": "front", "-X": "left", "-Y": "bottom", "-Z": "back"}


@dataclass(frozen=True)
class Camera:
    eye: np.ndarray
    target: np.ndarray
    up: np.ndarray
    fov_deg: float = FOV_DEG

    def frame(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The unit vectors ahead, to the right and upwards."""
        unit = lambda v: v / max(np.linalg.norm(v), 1e-8)
        ahead = unit(self.target - self.eye)
        right = unit(_cross(ahead[None], self.up[None])[0])
        return ahead, right, _cross(right[None], ahead[None])[0]

    def rays(self, res: int) -> np.ndarray:
        """Directions (res * res, 3), top row first."""
        ahead, right, over = self.frame()
        span = np.linspace(-1, 1, res) * np.tan(np.radians(self.fov_deg) / 2)
        d = ahead + span[None, :, None] * right - span[:, None, None] * over
        return (d / np.linalg.norm(d, axis=2, keepdims=True)).reshape(-1, 3)


def cameras(mesh: Mesh) -> dict[str, Camera]:
    low, high = mesh.vertices.min(0), mesh.vertices.max(0)
    centre, d = (low + high) / 2, max(float(np.linalg.norm(high - low)) / 2, 1e-6) * DISTANCE
    return {k: Camera(centre + d * np.array(v, float), centre, np.array(u, float)) for k, (v, u) in VIEWS.items()}


def _cross(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cross products of rows; np.cross spends most of its time on moving axes when rows are few."""
    out = np.empty(u.shape)
    for k in range(3):
        i, j = (k + 1) % 3, (k + 2) % 3
        out[:, k] = u[:, i] * v[:, j] - u[:, j] * v[:, i]
    return out


def _dot(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return u[:, 0] * v[:, 0] + u[:, 1] * v[:, 1] + u[:, 2] * v[:, 2]


def vertex_normals(mesh: Mesh) -> np.ndarray:
    tri = mesh.vertices[mesh.faces]
    n = _cross(tri[:, 1] - tri[:, 0], tri[:, 2] - tri[:, 0])
    out = np.stack([np.bincount(mesh.faces.ravel(), np.repeat(n[:, k], 3), len(mesh.vertices)) for k in range(3)], 1)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def shade(normals: np.ndarray, dirs: np.ndarray) -> np.ndarray:
    """Colours of hit points: normals are turned to the camera, then ambient, key and half the fill light."""
    normals = np.where(_dot(normals, dirs)[:, None] > 0, -normals, normals)
    light = lambda d: np.maximum(normals @ (-np.array(d) / np.linalg.norm(d)), 0)[:, None]
    return np.clip(BASE * (AMBIENT + light(KEY_DIR) * KEY_COLOR + 0.5 * light(FILL_DIR) * FILL_COLOR), 0, 1)


class Shots:
    """Meshes, each before the same number of cameras, as one scene: an image's vertices and faces are rows of their own, so a kernel's arrays span all images."""

    def __init__(self, meshes: list[Mesh], cams: list[list[Camera]], res: int) -> None:
        each, self.res = len(cams[0]), res
        flat = [c for own in cams for c in own]
        frames = [c.frame() for c in flat]
        nv, nf = (np.repeat([len(x) for x in t], each) for t in ([m.vertices for m in meshes], [m.faces for m in meshes]))
        self.first_face = np.cumsum(nf) - nf
        self.of_face = np.repeat(np.arange(len(flat)), nf)
        self.vertices = np.concatenate([np.tile(m.vertices, (each, 1)) for m in meshes])
        self.faces = np.concatenate([np.tile(m.faces, (each, 1)) for m in meshes]) + (np.cumsum(nv) - nv)[self.of_face, None]
        self.eye = np.array([c.eye for c in flat])
        of = np.repeat(np.arange(len(flat)), nv)
        self.rel = self.vertices - self.eye[of]
        along = [_dot(self.rel, np.array([f[k] for f in frames])[of]) for k in range(3)]
        self.depth = along[0]
        scale = np.array([(res - 1) / 2 / np.tan(np.radians(c.fov_deg) / 2) for c in flat])[of, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            self.at = np.stack([along[1], -along[2]], 1) / self.depth[:, None] * scale + (res - 1) / 2  # column, row
        kinds = [(np.array(f).tobytes(), c.fov_deg) for f, c in zip(frames, flat, strict=True)]
        number = {k: n for n, k in enumerate(dict.fromkeys(kinds))}
        self.kind = np.array([number[k] for k in kinds])
        self.rays = np.concatenate([flat[kinds.index(k)].rays(res) for k in number])  # once for all images that look the same way

    def dirs(self, pixel: np.ndarray) -> np.ndarray:
        """Directions of rays; image n's pixels are numbered from n * res * res."""
        size = self.res * self.res
        image = pixel // size
        return self.rays[pixel + (self.kind[image] - image) * size]

    def hits(self, chunk: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
        """The nearest face (-1: none) and its distance for each pixel of every image, as first_hits gives them.

        Triangles are projected, and only the rays of the pixels below their projection meet them, so the work
        grows with the pixels that triangles cover. A triangle that reaches behind the camera meets all rays.
        """
        res, f, rel = self.res, self.faces, self.rel
        n = len(self.eye) * res * res
        face, dist = np.full(n, -1), np.full(n, np.inf)
        behind = (self.depth[f] <= 1e-9).any(1)
        corner = np.where(behind[:, None, None], 0.0, self.at[f])
        low, high = np.floor(corner.min(1) - 1e-6), np.ceil(corner.max(1) + 1e-6)
        low[behind], high[behind] = 0, res - 1
        seen = (high >= 0).all(1) & (low <= res - 1).all(1)
        low, high = np.clip(low, 0, res - 1).astype(np.int64), np.clip(high, 0, res - 1).astype(np.int64)
        size = np.where(seen[:, None], high - low + 1, 0)
        count = size.prod(1)
        ends, start = np.cumsum(count), 0
        a = rel[f[:, 0]]
        e1, e2 = ((rel[f[:, c]] - a).T.copy() for c in (1, 2))  # by axis: long rows are quicker to work on than rows of three
        s, rays = -a.T, self.rays.T.copy()
        cross = lambda u, v: [u[i] * v[j] - u[j] * v[i] for i, j in ((1, 2), (2, 0), (0, 1))]
        dot = lambda u, v: u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
        while start < len(f):
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + chunk)))
            k = np.repeat(np.arange(start, stop), count[start:stop])
            j = np.arange(len(k)) + done - np.repeat(ends[start:stop] - count[start:stop], count[start:stop])
            wide = size[k, 0]
            down = j // wide
            ray = (low[k, 1] + down) * res + low[k, 0] + j - down * wide
            pixel = ray + self.of_face[k] * (res * res)
            d = rays[:, ray + self.kind[self.of_face[k]] * (res * res)]
            h = cross(d, e2[:, k])
            det = dot(h, e1[:, k])
            with np.errstate(divide="ignore", invalid="ignore"):
                inv = 1 / det
                u = dot(s[:, k], h) * inv
                some = np.flatnonzero((np.abs(det) > 1e-14) & (u >= 0) & (u <= 1))  # rays in a triangle's plane fail the first test
                k, pixel, d, inv, u = k[some], pixel[some], d[:, some], inv[some], u[some]
                q = cross(s[:, k], e1[:, k])
                w, t = dot(d, q) * inv, dot(q, e2[:, k]) * inv
                good = np.flatnonzero((w >= 0) & (u + w <= 1) & (t > 1e-9))
            good = good[np.lexsort((k[good], t[good], pixel[good]))]  # of equal distances the first face
            good = good[np.append(True, np.diff(pixel[good]) != 0)] if len(good) else good
            nearer = t[good] < dist[pixel[good]]
            dist[pixel[good[nearer]]], face[pixel[good[nearer]]] = t[good[nearer]], k[good[nearer]]
            start = stop
        return face, dist


def camera_hits(mesh: Mesh, camera: Camera, res: int, chunk: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """The nearest triangle (-1: none) and its distance for each of the camera's rays."""
    return Shots([mesh], [[camera]], res).hits(chunk)


def _colours(shots: Shots, normals: np.ndarray, hit: np.ndarray, face: np.ndarray, dist: np.ndarray) -> np.ndarray:
    """Colours of the pixels `hit`, whose faces and distances are given; normals are those of the scene's vertices."""
    dirs = shots.dirs(hit)
    p = shots.eye[hit // (shots.res * shots.res)] + dirs * dist[:, None]
    f = shots.faces[face]
    a, b, c = (shots.vertices[f[:, k]] for k in range(3))
    area = lambda u, v: np.linalg.norm(_cross(u - p, v - p), axis=1)
    whole = np.maximum(np.linalg.norm(_cross(b - a, c - a), axis=1), 1e-20)
    w = np.stack([area(b, c) / whole, area(c, a) / whole], 1)
    w = np.column_stack([w, np.maximum(1 - w.sum(1), 0)])
    n = (w[:, :, None] * normals[f]).sum(1)
    return shade(n / np.maximum(np.linalg.norm(n, axis=1, keepdims=True), 1e-12), dirs)


def render_images(meshes: list[Mesh], cams: list[list[Camera]], res: int = 512, supersample: int = 2) -> np.ndarray:
    """uint8 (meshes, cameras, res, res, 3), samples averaged over supersample x supersample blocks and cut to whole numbers."""
    hi, each = res * max(1, supersample), len(cams[0])
    shots = Shots(meshes, cams, hi)
    face, dist = shots.hits()
    image, hit = np.full((len(face), 3), BACKGROUND), np.flatnonzero(face >= 0)
    if len(hit):
        normals = np.concatenate([np.tile(vertex_normals(m), (each, 1)) for m in meshes])
        image[hit] = _colours(shots, normals, hit, face[hit], dist[hit])
    image = image.reshape(len(meshes), each, res, hi // res, res, hi // res, 3).mean((3, 5))
    return np.clip(image * 255, 0, 255).astype(np.uint8)


#: Samples in the box of a triangle that is drawn by itself, how many smaller ones are beside such, and samples of a tile and rows of a band, whose arrays stay in a core's cache.
ALONE, FEW, TILE, BAND = 1 << 12, 256, 1 << 13, 64


class Canvas:
    """One camera's samples, on which each large triangle is drawn by itself.

    A sample's direction is a vector of its row plus one of its column, so all that is linear in it is a number of the row plus
    a number of the column: the planes through the eye and a side, one over the depth, and the normal between the corners. The samples of
    a row inside a side's plane are therefore a range whose end is looked up, and neighbours across a side share it without a gap.
    """

    def __init__(self, mesh: Mesh, camera: Camera, res: int) -> None:
        ahead, right, over = camera.frame()
        self.frame, self.res = np.stack([right, over, ahead], 1), res
        self.span = np.linspace(-1, 1, res) * np.tan(np.radians(camera.fov_deg) / 2)
        at = (mesh.vertices - camera.eye) @ self.frame
        self.corners = a, b, c = tuple(at[mesh.faces[:, k]] for k in range(3))
        self.plane = _cross(b - a, c - a)
        self.size = _dot(a, self.plane)
        depth = np.stack([x[:, 2] for x in self.corners], 1)
        self.behind = (depth <= 1e-9).any(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            place = np.stack([x[:, :2] / x[:, 2:] * [1, -1] for x in self.corners], 1) / self.span[-1] * ((res - 1) / 2) + (res - 1) / 2  # column, row
            seen = np.abs(self.size) / depth.min(1) > 1e-14  # not from its side
        place[self.behind] = [[0, 0], [res, res], [0, 0]]
        low, high = np.floor(place.min(1) - 1e-6), np.ceil(place.max(1) + 1e-6)
        on = (high >= 0).all(1) & (low <= res - 1).all(1)
        low, high = (np.clip(np.where(on[:, None], x, 0), 0, res - 1).astype(np.int64) for x in (low, high))
        self.rows = np.stack([low[:, 1], high[:, 1] + 1], 1)
        self.large = on & ((high - low + 1).prod(1) >= ALONE)
        self.small = on & ~self.large
        if self.large.any() and self.small.sum() <= FEW:
            self.large, self.small = on, on & False
        self.seen = seen | self.behind & (self.size != 0)

    def _parts(self, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the rows and of the columns of vectors (..., 3) times the directions."""
        return forms[..., 2:] - forms[..., 1:2] * self.span, forms[..., :1] * self.span

    def triangle(self, k: int, normals: np.ndarray) -> Triangle:
        """normals are those of its corners (3, 3)."""
        a, b, c = (x[k : k + 1] for x in self.corners)
        sides = np.concatenate([_cross(b, c), _cross(c, a), _cross(a, b)]) * np.sign(self.size[k])  # of the corner across; inside is where none is negative
        first, end = self.rows[k]
        low, high = np.zeros(self.res, np.int64), np.zeros(self.res, np.int64)
        high[first:end] = self.res
        for down, across, rises in zip(*self._parts(sides), sides[:, 0] >= 0, strict=True):
            if rises:
                np.maximum(low, np.searchsorted(across, -down), out=low)
            else:
                np.minimum(high, self.res - np.searchsorted(across[::-1], -down), out=high)
        some = np.flatnonzero(low < high)
        lights = [normals @ (-np.array(d) / np.linalg.norm(d)) for d in (KEY_DIR, FILL_DIR)]
        told = np.vstack([np.vstack([(normals @ self.frame).T, *lights]) @ sides, self.plane[k] * np.sign(self.size[k]), self.plane[k] / self.size[k]])
        return Triangle(k, bool(self.behind[k]), low, high, (int(some[0]), int(some[-1]) + 1) if len(some) else (0, 0), *self._parts(told))


@dataclass(frozen=True)
class Triangle:
    """The columns low .. high that a triangle covers in each row, its first row and the one after its last, and the numbers of rows and columns of its normal, its two lights, its plane and one over its depth."""

    k: int
    behind: bool
    low: np.ndarray
    high: np.ndarray
    rows: tuple[int, int]
    down: np.ndarray
    across: np.ndarray

    def tiles(self, first: int, end: int):
        """Rows and columns that hold the samples of the triangle in the rows first .. end."""
        first, end = max(first, self.rows[0]), min(end, self.rows[1])
        some = self.low[first:end] < self.high[first:end]
        if not some.any():
            return
        step = max(1, TILE // int((self.high - self.low)[first:end].max()))
        for at in range(first, end, step):
            y = slice(at, min(at + step, end))
            some = self.low[y] < self.high[y]
            if some.any():
                yield y, slice(int(self.low[y][some].min()), int(self.high[y][some].max()))

    def draw(self, start: int, near: np.ndarray, face: np.ndarray) -> None:
        """Into a band's (rows, columns) of one over the depth, and of the face there, from the row `start` on."""
        for y, x in self.tiles(start, start + len(near)):
            at, columns = (slice(y.start - start, y.stop - start), x), np.arange(x.start, x.stop)
            new, old = self.down[-1, y, None] + self.across[-1, x], near[at]
            inside = columns >= self.low[y, None]
            inside &= columns < self.high[y, None]
            inside &= new > old
            if self.behind:
                inside &= new < 1e9
            np.copyto(old, new, where=inside)
            np.copyto(face[at], self.k, where=inside)

    def paint(self, start: int, face: np.ndarray, image: np.ndarray, span: np.ndarray) -> None:
        """Colours, as shade() gives them, of a band's samples that are the triangle's, into its (3, rows, columns)."""
        for y, x in self.tiles(start, start + len(face)):
            at = slice(y.start - start, y.stop - start), x
            own = face[at] == self.k
            if not own.any():
                continue
            right, over, ahead, key, fill, whole = (d[y, None] + a[x] for d, a in zip(self.down[:-1], self.across[:-1], strict=True))
            toward = right * span[x]
            toward -= over * span[y, None]
            toward += ahead
            for n in (right, over, ahead):
                n *= n
            right += over
            right += ahead
            whole *= 1e-12
            size = np.maximum(np.sqrt(right, out=right), whole, out=right)
            with np.errstate(divide="ignore", invalid="ignore"):  # beside the triangle the whole may be 0
                turn = np.where(toward > 0, -1.0, 1.0)
                turn /= size
                for light in (key, fill):
                    light *= turn
                    np.maximum(light, 0, out=light)
            for plane, of_key, of_fill in zip(image, KEY_COLOR, FILL_COLOR, strict=True):
                colour = np.multiply(key, BASE * of_key, out=over)
                colour += np.multiply(fill, BASE * 0.5 * of_fill, out=ahead)
                colour += BASE * AMBIENT
                np.copyto(plane[at], np.minimum(colour, 1, out=colour), where=own)


def _canvas_view(mesh: Mesh, camera: Camera, canvas: Canvas, res: int) -> np.ndarray:
    """uint8 (res, res, 3) of a mesh some of whose triangles are large, in bands of rows; the other triangles are met by the rays below them."""
    hi, s, normals = canvas.res, canvas.res // res, vertex_normals(mesh)
    rest = np.flatnonzero(canvas.small)
    if len(rest):
        shots = Shots([Mesh(mesh.vertices, mesh.faces[rest])], [[camera]], hi)
        found, dist = shots.hits()
        hit = np.flatnonzero(found >= 0)
    alone = [canvas.triangle(k, normals[mesh.faces[k]]) for k in np.flatnonzero(canvas.large & canvas.seen).tolist()]
    out = np.full((res, res, 3), np.clip(BACKGROUND * 255, 0, 255), np.uint8)
    band = s * max(1, BAND // s)
    for start in range(0, hi, band):
        end = min(start + band, hi)
        if not len(rest) and not any(t.rows[0] < end and t.rows[1] > start for t in alone):
            continue
        near, face, image = np.zeros((end - start, hi)), np.full((end - start, hi), -1), np.full((3, end - start, hi), BACKGROUND)
        if len(rest):
            own = hit[np.searchsorted(hit, start * hi) : np.searchsorted(hit, end * hi)]
            face.ravel()[own - start * hi] = rest[found[own]]
            near.ravel()[own - start * hi] = 1 / (dist[own] * (shots.dirs(own) @ canvas.frame[:, 2]))
        for t in alone:
            t.draw(start, near, face)
        for t in alone:
            t.paint(start, face, image, canvas.span)
        if len(rest):
            own = own[canvas.small[face.ravel()[own - start * hi]]]
            image.reshape(3, -1)[:, own - start * hi] = _colours(shots, normals, own, found[own], dist[own]).T
        mean = image[:, ::s, ::s].copy()
        for i, j in list(np.ndindex(s, s))[1:]:
            mean += image[:, i::s, j::s]
        mean *= 255 / s**2
        out[start // s : end // s] = np.clip(mean, 0, 255, out=mean).transpose(1, 2, 0)
    return out


def render_view(mesh: Mesh, camera: Camera, res: int = 512, supersample: int = 2) -> np.ndarray:
    """uint8 (res, res, 3) of one camera."""
    canvas = Canvas(mesh, camera, res * max(1, supersample))
    return _canvas_view(mesh, camera, canvas, res) if canvas.large.any() else render_images([mesh], [[camera]], res, supersample)[0, 0]


def render_views(mesh: Mesh, names, res: int = 512, supersample: int = 2) -> dict[str, np.ndarray]:
    """The named views, one at a time, as large images take much memory."""
    if not len(mesh.faces):
        raise ValueError("mesh has no faces")
    at = cameras(mesh)
    return {k: render_view(mesh, at[k], res, supersample) for k in names}


def tile(views: list[np.ndarray], columns: int) -> np.ndarray:
    """Equal images in rows of `columns`, in order."""
    if not views or len(views) % columns:
        raise ValueError(f"{len(views)} views don't fill rows of {columns}")
    return np.vstack([np.hstack(views[k : k + columns]) for k in range(0, len(views), columns)])


def four_view_grid(views: dict[str, np.ndarray]) -> np.ndarray:
    if len(views) != 4:
        raise ValueError("a 2 x 2 grid takes exactly four views")
    return tile([views[k] for k in FOUR], 2)


def six_view_grid(mesh: Mesh, res: int = 384, supersample: int = 2) -> np.ndarray:
    """+X +Y +Z over -X -Y -Z."""
    views = render_views(mesh, SIX.values(), res, supersample)
    return tile([views[k] for k in SIX.values()], 3)


def png(image: np.ndarray) -> bytes:
    h, w, _ = image.shape
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    raw = np.hstack([np.zeros((h, 1), np.uint8), image.reshape(h, -1)]).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


#: Samples and faces, over all views, of meshes that are rendered at once.
TOGETHER = 1 << 14


def render_grids(packed: DataFrame, res: int = 512, supersample: int = 2, six: bool = False, timeout_s: float | None = None) -> DataFrame:
    """(mesh_id, width, height, png, seconds, error): the four-view grid of every packed mesh, or the six-view one. Small images of several meshes are rendered at once."""
    names, columns = (tuple(SIX.values()), 3) if six else (FOUR, 2)
    samples = (res * max(1, supersample)) ** 2

    def row(image: np.ndarray) -> dict:
        return {"width": image.shape[1], "height": image.shape[0], "png": png(image)}

    def kernel(mesh: Mesh) -> dict:
        return row(six_view_grid(mesh, res, supersample) if six else four_view_grid(render_views(mesh, FOUR, res, supersample)))

    def together(some: list[Mesh]) -> list[dict]:
        at = [cameras(m) for m in some]
        return [row(tile(list(views), columns)) for views in render_images(some, [[c[k] for k in names] for c in at], res, supersample)]

    def share(mesh: Mesh) -> float:
        """Of what is rendered at once; a mesh without faces or with strange ones goes alone."""
        fine = len(mesh.faces) and mesh.faces.min() >= 0 and mesh.faces.max() < len(mesh.vertices)
        return len(names) * (samples + len(mesh.faces)) / TOGETHER if fine else 1.0

    return map_meshes(packed, kernel, "width int, height int, png binary", heavy=True, timeout_s=timeout_s, clock=True, together=together, share=share)
