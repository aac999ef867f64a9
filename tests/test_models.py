import numpy as np
import pytest

from tessera.plans.models import model_summary_rows, n_params, preset, smallest_side


@pytest.mark.parametrize("name,params,side", [
    ("LeNet", 1_380_903, 20), ("AlexNet", 24_739_203, 61), ("VGGNet", 44_892_547, 32)])
def test_presets(name, params, side):
    spec = preset(name)
    assert n_params(spec) == params
    assert smallest_side(spec) == side


def test_alexnet_shapes_floor():
    rows = model_summary_rows(preset("AlexNet"))
    assert rows[0][4:7] == (96, 24, 24)
    assert rows[2][4:7] == (96, 11, 11)
    assert rows[9][4:7] == (256, 2, 2)


def test_lenet_second_conv_uses_stride_5():
    rows = model_summary_rows(preset("LeNet"))
    assert rows[2][4:7] == (100, 10, 10)


def test_unknown_model_and_small_input():
    with pytest.raises(ValueError):
        preset("ResNet")
    with pytest.raises(ValueError):
        n_params(preset("AlexNet", height=40, width=40))


def test_rule_warnings_match_configuration():
    from tessera.plans.models import effective_l2, rule_warnings
    w = rule_warnings(preset("LeNet"))
    assert any("momentum" in x for x in w) and any("l2" in x for x in w)
    assert effective_l2(preset("LeNet")) == 0.0
    assert effective_l2(preset("AlexNet")) == 5e-4
    assert rule_warnings(preset("AlexNet")) == []


def test_presets_compute_in_float32():
    import numpy as np
    from tessera.plans.models import batch_input, forward, init_params
    spec = preset("LeNet", channels=1, height=20, width=20, num_labels=3)
    params = init_params(spec)
    assert all(v.dtype == np.float32 for v in params.values())
    x = batch_input(spec.with_scale(1 / 255), [bytes(range(200)) * 2])
    p, _ = forward(spec, params, x)
    assert x.dtype == np.float32 and p.dtype == np.float32 and abs(float(p.sum()) - 1) < 1e-5


@pytest.mark.parametrize("name", ["LeNet", "AlexNet", "VGGNet"])
def test_spec_json_roundtrip(name):
    from tessera.plans.models import spec_from_json, spec_to_json
    spec = preset(name).with_scale(1 / 255)
    assert spec_from_json(spec_to_json(spec)) == spec


def test_spec_with_dropout_layers_roundtrips():
    from tessera.plans.models import Dropout, NetSpec, Output, spec_from_json, spec_to_json
    spec = NetSpec("d", (4,), (Dropout("drop", 0.25), Output("out", 2)))
    assert spec_from_json(spec_to_json(spec)) == spec


def test_float32_survives_a_training_step_with_dropout():
    import numpy as np
    from tessera.plans.training import new_model, train_batch
    spec = preset("AlexNet", channels=3, height=61, width=61, num_labels=3)
    m = new_model(spec)
    x = np.random.default_rng(0).random((2, 3, 61, 61)).astype("float32")
    train_batch(spec, m, x, np.array([0, 2]), np.random.default_rng(1))
    assert {v.dtype for v in m.params.values()} == {np.dtype("float32")}
    assert {v.dtype for v in m.state.values()} == {np.dtype("float32")}


# Per-layer output shapes and parameter counts of the three
# presets at 100x100x3 input and 3 classes (floor division).
PRESET_LAYERS = [
('LeNet', 0, 'cnn1', 'conv', 50, 96, 96, 3800),
('LeNet', 1, 'maxpool1', 'pool', 50, 48, 48, 0),
('LeNet', 2, 'cnn2', 'conv', 100, 10, 10, 125100),
('LeNet', 3, 'maxool2', 'pool', 100, 5, 5, 0),
('LeNet', 4, 'dense', 'dense', 500, 1, 1, 1250500),
('LeNet', 5, 'output', 'output', 3, 1, 1, 1503),
('AlexNet', 0, 'cnn1', 'conv', 96, 24, 24, 34944),
('AlexNet', 1, 'lrn1', 'lrn', 96, 24, 24, 0),
('AlexNet', 2, 'maxpool1', 'pool', 96, 11, 11, 0),
('AlexNet', 3, 'cnn2', 'conv', 256, 11, 11, 614656),
('AlexNet', 4, 'lrn2', 'lrn', 256, 11, 11, 0),
('AlexNet', 5, 'maxpool2', 'pool', 256, 5, 5, 0),
('AlexNet', 6, 'cnn3', 'conv', 384, 5, 5, 885120),
('AlexNet', 7, 'cnn4', 'conv', 384, 5, 5, 1327488),
('AlexNet', 8, 'cnn5', 'conv', 256, 5, 5, 884992),
('AlexNet', 9, 'maxpool3', 'pool', 256, 2, 2, 0),
('AlexNet', 10, 'ffn1', 'dense', 4096, 1, 1, 4198400),
('AlexNet', 11, 'ffn2', 'dense', 4096, 1, 1, 16781312),
('AlexNet', 12, 'output', 'output', 3, 1, 1, 12291),
('VGGNet', 0, 'cnn1', 'conv', 64, 100, 100, 1792),
('VGGNet', 1, 'maxpool1', 'pool', 64, 50, 50, 0),
('VGGNet', 2, 'cnn2', 'conv', 128, 50, 50, 73856),
('VGGNet', 3, 'maxpool2', 'pool', 128, 25, 25, 0),
('VGGNet', 4, 'cnn3', 'conv', 256, 25, 25, 295168),
('VGGNet', 5, 'cnn4', 'conv', 256, 25, 25, 590080),
('VGGNet', 6, 'maxpool3', 'pool', 256, 12, 12, 0),
('VGGNet', 7, 'cnn5', 'conv', 512, 12, 12, 1180160),
('VGGNet', 8, 'cnn6', 'conv', 512, 12, 12, 2359808),
('VGGNet', 9, 'maxpool4', 'pool', 512, 6, 6, 0),
('VGGNet', 10, 'cnn7', 'conv', 512, 6, 6, 2359808),
('VGGNet', 11, 'cnn8', 'conv', 512, 6, 6, 2359808),
('VGGNet', 12, 'maxpool5', 'pool', 512, 3, 3, 0),
('VGGNet', 13, 'ffn1', 'dense', 4096, 1, 1, 18878464),
('VGGNet', 14, 'ffn2', 'dense', 4096, 1, 1, 16781312),
('VGGNet', 15, 'output', 'output', 3, 1, 1, 12291),
]


def test_shape_walk_of_the_presets():
    got = [r for name in ("LeNet", "AlexNet", "VGGNet") for r in model_summary_rows(preset(name))]
    assert got == PRESET_LAYERS


def test_packed_inputs_have_the_type_the_spec_names():
    from tessera.plans.models import batch_input, small_dense_net
    quarter = np.zeros(4, np.float32).tobytes()  # 16 bytes: four floats, or sixteen pixels
    assert batch_input(small_dense_net(4, 2), [quarter]).shape == (1, 4)
    with pytest.raises(ValueError, match="packed example"):
        batch_input(small_dense_net(16, 2), [quarter])
    assert batch_input(small_dense_net(16, 2).with_scale(1 / 255), [quarter]).shape == (1, 16)
